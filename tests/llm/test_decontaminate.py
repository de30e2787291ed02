import random

from pyspark.sql import functions as F

from corpusproof.llm.decontaminate import BITS, BLOCKS, LONGEST, RADIUS, block_keys, contaminations, linked_windows, without_contamination


def shingles(words):
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def every_link(texts, items):
    """{(doc, item, start, size)} by brute force over all windows of all items' sizes, at every place."""
    of = {i: shingles(t.lower().split()) for i, t in items}
    shared = {}
    for own in of.values():
        for s in own:
            shared[s] = shared.get(s, 0) + 1
    weight = lambda s: 1 / shared.get(s, 1)
    found = set()
    for doc, text in texts:
        words = text.lower().split()
        for item, t in items:
            n, mass = len(t.split()), sum(map(weight, of[item]))
            for start in range(5 - n, len(words) - 4):
                own = shingles(words[max(start, 0) : start + n])
                both = sum(map(weight, own & of[item]))
                if both and both / (sum(map(weight, own)) + mass - both) >= 0.8 - 1e-9:
                    found.add((doc, item, start, n))
    return found


def planted(rng):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    items = [(k, " ".join(word() for _ in range(rng.randint(5, 60)))) for k in range(12)]
    items.append((12, items[0][1] + " " + items[1][1]))  # shares shingles
    items.append((13, "too short for that"))
    texts = []
    for d in range(70):
        body = [word() for _ in range(rng.randint(0, 150))]
        if d % 2:
            own = rng.choice(items)[1].split()
            for _ in range(rng.choice([0, 0, 1, 2, 5])):  # changed, dropped and added words
                at = rng.randrange(len(own))
                own[at : at + 1] = rng.choice([[word()], [], [own[at], word()]])
            own = own[rng.choice([0, 0, 1, 3]) :] or own
            at = rng.randrange(len(body) + 1)
            body[at:at] = [w.upper() if rng.random() < 0.1 else w for w in own]
        texts.append((d, " ".join(body)))
    return texts, items


def test_links_of_all_windows_against_brute_force(spark):
    texts, items = planted(random.Random(9))
    docs, bench = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = every_link(texts, items)
    got = {(r.key, r.item_id, r.start, r.size) for r in linked_windows(docs, bench).collect()}
    assert got <= want  # the check of candidates is exact
    assert len(got) >= 0.97 * len(want), (len(got), len(want))
    best = contaminations(docs, bench).collect()
    found, wanted = {(r.doc_id, r.item_id) for r in best}, {(d, i) for d, i, _, _ in want}
    assert len(found) == len(best) and found <= wanted and len(found) >= 0.97 * len(wanted)
    wide = {(r.key, r.item_id, r.start, r.size) for r in linked_windows(docs, bench, radius=23).collect()}
    assert wide == want  # at a radius that no pair of these exceeds, nothing is lost
    clean = {d for d, _ in texts} - {d for d, _ in found}
    assert {r.doc_id for r in without_contamination(docs, bench).collect()} == clean


def test_keys_hold_every_print_within_the_radius(spark):
    rng = random.Random(4)
    own, size = rng.getrandbits(BITS), F.lit(20)
    keys = set(spark.range(1).select(block_keys(F.lit(own), size, BLOCKS, RADIUS // BLOCKS)).first()[0])
    others = []
    for _ in range(300):
        other = own
        for i in rng.sample(range(BITS), RADIUS):
            other ^= 1 << i
        others.append((other,))
    rows = spark.createDataFrame(others, "p long").select(block_keys(F.col("p"), size, BLOCKS)).collect()
    assert all(keys & set(r[0]) for r in rows)
    assert not keys & set(spark.range(1).select(block_keys(F.lit(own), F.lit(21), BLOCKS)).first()[0])


def test_long_items_are_searched_in_parts(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(9999)}" for _ in range(2 * LONGEST + 7)]
    texts = [(1, " ".join(["before"] * 3 + words[:200] + ["after"])), (2, " ".join(words[:40])), (3, " ".join(words))]
    found = contaminations(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")).collect()
    assert {r.doc_id for r in found} == {1, 3} and {r.item_id for r in found} == {7}


def test_awkward_rows(spark, awkward, nothing):
    bench = spark.createDataFrame([(1, None), (None, "a b c d e f"), (2, ""), (3, awkward.where("doc_id = 1").first().text)], "item_id long, text string")
    hits = contaminations(awkward, bench).collect()
    assert {r.doc_id for r in hits} >= {1, 2, 3} and {r.item_id for r in hits} == {3}
    assert len([r for r in hits if r.doc_id == 2]) == 1
    assert contaminations(nothing, bench).count() == 0 == contaminations(awkward, bench.where("item_id = 99")).count()
    kept = without_contamination(awkward, bench)
    assert kept.columns == awkward.columns and kept.count() == awkward.count() - 1 - len(hits)
    assert without_contamination(awkward, bench.limit(0)).count() == awkward.count()
    # ids that repeat with other texts, or are null, are judged by their own texts
    item = awkward.where("doc_id = 1").first().text
    rows = spark.createDataFrame([(None, item), (None, "fine"), (5, item), (5, "fine"), (6, None)], "doc_id long, text string").selectExpr("doc_id", "text", "1 as key", "2 as tie", "3 as own0")
    assert sorted((r.doc_id or 0, r.text) for r in without_contamination(rows, bench).where("text is not null").collect()) == [(0, "fine"), (5, "fine")]
