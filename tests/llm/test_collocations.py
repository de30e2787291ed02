import random
import re
from collections import Counter

import duckdb
import pyarrow as pa
import pytest

import corpusproof.llm.collocations as module
from corpusproof.llm.collocations import collocations
from corpusproof.llm.queries import ORACLES, op11_collocations

FIELDS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, support, longest=5, top=2000):
    count, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    count[lang, tuple(words[i : i + k])] += 1
    frequent = {p: a for p, a in count.items() if len(p[1]) > 1 and a >= support}
    best = []
    for (lang, p), a in frequent.items():
        inside = any(x[0] == lang and len(x[1]) > len(p) and b >= a and any(x[1][i : i + len(p)] == p for i in range(len(x[1]))) for x, b in frequent.items())
        if not inside:
            cuts = [(1000 * a * n[lang] // (count[lang, p[:k]] * count[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            best.append((lang, -score, -a, " ".join(p).encode(), count[lang, p[:k]], count[lang, p[k:]]))
    out, ranks = [], Counter()
    for lang, score, a, phrase, left, right in sorted(best):
        ranks[lang] += 1
        if ranks[lang] <= top:
            out.append((lang, ranks[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return out


def found(df, **more):
    return sorted(tuple(r[f] for f in FIELDS) for r in collocations(df, **more).collect())


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(4)
    base = ["ab", "Ba", "c", "dé", "é", "x\xa0y", "e\x1cf"]
    rows = [(rng.choice(["en", "de", None]), "".join(rng.choice([*base, "one two three four five"]) + rng.choice([" "] * 9 + ["\t", " \t ", ", ", ".", "\n", "\x0b", "!?"]) for _ in range(rng.randint(1, 60)))) for _ in range(120)]
    return rows + rows[:30], spark.createDataFrame(rows + rows[:30], "lang string, text string")


@pytest.mark.parametrize("support", [1, 7, 40])
def test_all_phrases_against_brute_force(planted, support):
    rows, df = planted
    want = brute(rows, support, top=300)
    assert len(want) > 2 and found(df, support=support, top=300) == sorted(want)


def test_a_full_map_loses_nothing(planted, monkeypatch):
    rows, df = planted
    monkeypatch.setattr(module, "BITS", 1 << 6)
    assert found(df, support=7) == sorted(brute(rows, 7))


def test_a_phrase_inside_a_longer_one_of_as_many_occurrences_goes(spark):
    df = spark.createDataFrame([("en", "a b c. a b c. a b c. a b. x x x x")], "lang string, text string")
    got = {r[2]: r[3] for r in found(df, support=3)}
    assert got == {"a b": 4, "a b c": 3, "x x": 3}


def test_ratios_beyond_64_bits_are_exact(spark):
    # counts as of a large corpus
    words = spark.createDataFrame([(1, "a", 3_000_000_000_001), (1, "b", 7)], "lang_key long, phrase string, n long")
    phrases = spark.createDataFrame([(1, "a b", 7)], "lang_key long, phrase string, n long")
    totals = spark.createDataFrame([(1, 900_000_000_000_000_003)], "lang_key long, n long")
    (row,) = module._ranked(words, phrases, totals, 10).collect()
    assert row.low.score == 1000 * 7 * 900_000_000_000_000_003 // (3_000_000_000_001 * 7)


def test_awkward_rows(awkward, nothing):
    rows = [(r.lang, r.text) for r in awkward.collect()]
    assert found(awkward, support=4, top=100) == sorted(brute(rows, 4, top=100))
    assert collocations(nothing).count() == 0


def made(spark, node, since):
    """Rows that came out of the plan nodes so described, in executions from ``since`` on."""
    store = spark._jsparkSession.sharedState().statusStore()
    runs, total = store.executionsList(), 0
    for i in range(since, runs.size()):
        nodes, values = store.planGraph(runs.apply(i).executionId()).allNodes(), store.executionMetrics(runs.apply(i).executionId())
        for each in (nodes.apply(j) for j in range(nodes.size())):
            metrics = each.metrics()
            for metric in (metrics.apply(k) for k in range(metrics.size()) if node in each.desc()):
                if metric.name() == "number of output rows" and values.get(metric.accumulatorId()).isDefined():
                    total += int(values.get(metric.accumulatorId()).get().replace(",", ""))
    return total


def test_the_counting_pass_makes_rows_by_cores_and_not_by_the_size_of_the_input(spark):
    spark.range(0, 64, 1, 32).selectExpr("'en' AS lang", "repeat('one two three four five. ', 16000) || id AS text").createOrReplaceTempView("large")
    before = spark._jsparkSession.sharedState().statusStore().executionsList().size()
    got = {r[2]: r[3] for r in found(spark.table("large"))}
    assert got == {"one two three four five": 64 * 16_000}
    # ten phrases, two tasks for each of four cores; a task reads 3 MB
    assert 10 <= made(spark, "MapInArrow count", before) <= 10 * 8


def test_combined_counts_lose_nothing(monkeypatch):
    monkeypatch.setattr(module, "COUNTS", 40)
    rng, want, handed = random.Random(6), Counter(), []
    for size, of in [(0, 1)] + [(9, 20)] * 40 + [(0, 1), (90, 2**62)] + [(30, 2**62)] * 4:
        # keys on both sides of 2**63; sometimes another phrase or language has the key
        keys = sorted({rng.randint(1, of) * 3 % 2**64 for _ in range(size)})
        rows = [(rng.choice([1, 1, 1, 2]), key - 2**64 * (key >= 2**63), f"{rng.choice('ééée')} {key}", rng.randint(1, 2**40)) for key in keys]
        for *told, n in rows:
            want[tuple(told)] += n
        handed.append(pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [()] * 4, [pa.int64(), pa.int64(), pa.string(), pa.int64()])], names=module._COUNTED))
    got, batches = Counter(), list(module._combined(iter(handed)))
    for r in (r for b in batches for r in b.to_pylist()):
        got[r["lang_key"], r["key"], r["phrase"]] += r["n"]
    assert got == want and len(batches) > 2 and sum(map(len, batches)) < sum(map(len, handed)) and list(module._combined(iter([]))) == []


def test_the_query_equals_its_sql(spark):
    d = "/root/testdata/sf0.01"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    want = db.execute(f"SELECT {', '.join(FIELDS)} FROM ({ORACLES['op11_collocations']})").fetchall()
    assert len(want) > 50 and sorted(tuple(r[f] for f in FIELDS) for r in op11_collocations(spark, d).collect()) == sorted(want)
