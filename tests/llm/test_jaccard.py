import random
import re
from collections import Counter, defaultdict

from corpusproof.llm.components import connected_components
from corpusproof.llm.jaccard_join import jaccard_components


def shingles(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if len(words) < 3:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 3]) for i in range(len(words) - 2))


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    up = list(range(len(sets)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(k)
    for k, (_, s) in enumerate(sets):
        for o, n in Counter(o for x in s for o in holders[x] if o < k).items():
            if 100 * n >= 90 * len(s | sets[o][1]):
                up[find(k)] = find(o)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return Counter((i, len(s), least.get(find(k), None) if s else i) for k, (i, s) in enumerate(sets))


def result(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(df).collect())


def test_awkward_rows(awkward, nothing):
    assert result(awkward) == brute([(r.doc_id, r.text) for r in awkward.collect()])
    assert jaccard_components(nothing).count() == 0


def test_groups_of_near_copies(spark):
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(400)]
    rows, n = [], 0
    for _ in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(12, 160))]
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                copy = copy[: -rng.randint(1, 8)]
            rows.append((n, " ".join(copy)))
            n += 1
    passage = " ".join(vocabulary[:25])
    for _ in range(60):
        rows.append((n, passage + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30)))))
        n += 1
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_shortest_sets_that_link(spark):
    rows = []
    for n in range(1, 26):  # words, and the same with one word more at either end
        own = [f"n{n}x{k}" for k in range(n)]
        rows += [(10 * n, " ".join(own)), (10 * n + 1, " ".join([*own, "more"])), (10 * n + 2, " ".join(["less", *own]))]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(documents) == brute(rows)
    assert {r.doc_id: r.component_id for r in jaccard_components(documents).collect()}[111] == 110  # 10 against 9 shingles


def test_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}
