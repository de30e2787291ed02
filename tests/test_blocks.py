import random

from pyspark.sql import functions as F

from corpusproof.operators import entries


def test_quotes_near_lines_against_a_search_by_hand(spark):
    rng = random.Random(3)
    words = ["one", "two", "*three*", "Four", "five", "", "`six`"]
    files = {f"f{k}": [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 6]))) for _ in range(rng.randint(1, 150))] for k in range(6)}
    form = lambda t: " ".join(t.replace("*", "").replace("`", "").lower().split())
    rows, want = [], {}
    for n in range(500):
        name = rng.choice(list(files))
        body = files[name]
        cited, start = rng.randint(0, len(body) + 5), rng.randrange(len(body))
        quote = " ".join(" ".join(body[start : start + rng.choice([1, 2, 70])]).split()[: rng.choice([1, 4, 60])]) if rng.random() < 0.9 else "one never said"
        rows.append(("r", f"{name}:{cited}" if n % 50 else f"{name}:", quote))
        near, whole = form("\n".join(body[max(cited - 21, 0) : cited + 20])), form("\n".join(body))
        found = "malformed" if n % 50 == 0 else "no such place" if not 1 <= cited <= len(body) else "ok" if form(quote) and form(quote) in near else "not near" if form(quote) and form(quote) in whole else "not found"
        want[rows[-1]] = found
    lines = spark.createDataFrame([("r", f, k + 1, t) for f, body in files.items() for k, t in enumerate(body)], "repo string, path string, line int, text string")
    quotes = spark.createDataFrame(rows, "source string, where string, quote string")
    got = {(r.source, r["where"], r.quote): r.result for r in entries.line_evidence(quotes, lines).collect()}
    assert got == want and set(want.values()) == {"malformed", "no such place", "ok", "not near", "not found"}


def test_a_line_is_shuffled_into_two_blocks(spark):
    lines = spark.range(1, 1001).select(F.lit("r").alias("repo"), F.lit("f").alias("path"), F.col("id").alias("line"), F.lit("x").alias("form"))
    blocks = entries.line_blocks(lines, "line", 20, 40, 20).collect()
    assert sum(len(b.lines) for b in blocks) <= 2 * 1000 + 40
    assert all({x.at for x in b.lines} == set(range(max(40 * b.block - 20, 1), min(40 * b.block + 60, 1001))) for b in blocks)


def test_chapters_are_the_same_in_chunks_of_any_size(spark, monkeypatch):
    from corpusproof.operators import handbook

    rng = random.Random(8)
    kinds = ["## Title {}", "### Sub {}", "- item {}", "  - inner {}", "| a | {} |", "|---|---|", "", "", "text {}", "more {}", "```", "~~~", "````sql"]
    rows = [(f"d{d}", k, rng.choice(kinds).format(rng.randint(0, 3))) for d in range(8) for k in range(1, rng.randint(2, 120))]
    lines = spark.createDataFrame(rows, "area string, line int, text string")
    found = {}
    for size in (10**6, 7, 1):
        monkeypatch.setattr(handbook, "CHUNK", size)
        found[size] = sorted(map(tuple, handbook.chapter_blocks(lines).collect()))
        # lines outside fences, read one after another
        want, state = [], {}
        for d, k, text in rows:
            mark = text[:3] if text[:3] in ("```", "~~~") else ""
            now = state.get(d, "")
            state[d] = mark if mark and not now else "" if mark == now else now
            want += [(d, k, text)] if not mark and not now else []
        assert sorted(map(tuple, handbook.outside_fenced_lines(lines).collect())) == sorted(want)
    assert found[7] == found[1] == found[10**6] and len(found[7]) > 25


def test_secrets_have_places_and_overlaps_are_one(spark):
    from corpusproof.functions import text

    key, token = "AKIA" + "A" * 16, "ghp_" + "b" * 36
    body = f"é one\n{key} two {key}\ntoken = '{token}' end\n"
    rows = spark.createDataFrame([(body,), ("",), (None,)], "t string")
    rows = rows.withColumn("p", text.secret_places(F.col("t")))
    got = rows.withColumn("r", text.redacted_at(F.col("t"), F.col("p"))).collect()
    assert [(p.line, body[p.start : p.end], p.label) for p in got[0].p] == [(2, key, "AWS access key"), (2, key, "AWS access key"), (3, f"token = '{token}'", "password assignment")]
    assert got[0].r == "é one\n[REDACTED] two [REDACTED]\n[REDACTED] end\n" and [len(r.p) for r in got[1:]] == [0, 0]


def test_a_run_of_signs_in_cdata_is_text(spark):
    import time

    from corpusproof.functions import text

    html = "<p>a</p><![CDATA[" + "<" * 60_000 + " b]]><p>c</p>"
    begin = time.time()
    shown = spark.createDataFrame([(html,)], "h string").select(text.visible_text(F.col("h"))).first()[0].split()
    assert shown[0] == "a" and shown[-2:] == ["b", "c"] and time.time() - begin < 10


def test_preorder_numbers_are_those_of_the_paths(spark):
    from corpusproof.operators import pages

    rng = random.Random(5)
    rows = [(k, rng.choice([None, 9999, *range(max(k - 6, 0), k)]) if k else None, rng.randint(0, 10**6) * 1000 + k, 1) for k in range(120)]
    rows += [(1000, 1002, 1, 1), (1001, 1000, 2, 1), (1002, 1001, 3, 1), (1003, 1002, 4, 1)]  # a cycle, and a row below it
    df = spark.createDataFrame(rows, "page_id int, parent_id int, row_no int, n_words int")
    listed = {r.page_id: (r.depth, r.path) for r in pages.tree_listing(df).collect()}
    got = {r.page_id: (r.depth, r.place) for r in pages.preorder(df).collect()}
    inside = sorted((k for k in listed if listed[k][1]), key=lambda k: listed[k][1])
    assert [got[k] for k in inside] == [(listed[k][0], n) for n, k in enumerate(inside)] and len(inside) == 120
    assert all(got[k] == (None, None) for k in range(1000, 1004))


def test_a_deep_chain_has_numbers_without_paths(spark):
    from corpusproof.operators import pages

    n = 1000
    chain = spark.range(n).select(F.col("id").alias("page_id"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent_id"), F.col("id").alias("row_no"))
    assert pages.preorder(chain).agg(F.count_if((F.col("place") == F.col("page_id")) & (F.col("depth") == F.col("page_id")))).first()[0] == n


def test_many_names_are_found_as_one_by_one(spark):
    from corpusproof.functions.text import mentions
    from corpusproof.operators import handbook

    rng = random.Random(6)
    parts = ["Git", "Hub", "Actions", "k8s", "C++", "***", ".net", "a\\Eb", " ", " ", "-", "é"]
    names = ["GitHub", "GitHub Actions", "Git", "C++", "***", ".net", "k8s-Git", "a\\Eb", "Git"] + [f"name{k}" for k in range(2000)]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(60)] + ["name7 and name1999", None]
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id int, text string")
    got = sorted(map(tuple, handbook.platform_mentions(pages, names).collect()))
    few = [n for n in names[:8]] + ["name7", "name1999"]
    hit = F.array_compact(F.array(*(F.when(mentions(F.col("text"), n), F.lit(n)) for n in few)))
    assert got == sorted(map(tuple, pages.select("page_id", F.explode(hit)).collect())) and len(got) > 40
