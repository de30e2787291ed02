import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from corpusproof.llm.queries import op13_spelling_variants
from corpusproof.llm.spelling import SortedLists, variant_groups, vocabulary

SCHEMA = "doc_id long, text string"


def words_of(rows, least=5, support=3, every=97):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                count[run] += 1
    return {w: n for w, n in count.items() if n >= support}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def brute(count):
    out = {}
    for w in count:
        near = [x for x in count if one_edit(w, x)]
        best = min(near, key=lambda x: (-count[x], x), default=None)
        form = best if best and count[best] >= 2 * count[w] else None
        out[w] = [count[w], len(near), form, count[form] if form else None]
    for w in count:
        root = w
        while out[root][2]:
            root = out[root][2]
        out[w].append(root)
    return out


def found(spark, rows, **more):
    got = variant_groups(spark.createDataFrame(rows, SCHEMA), **more)
    return {r.word: [r.n, r.n_near, r.form, r.form_n, r.root] for r in got.collect()}


@pytest.mark.parametrize("hot", [20_000, 4])
def test_all_pairs_are_found_in_whole_and_in_split_lists(spark, hot):
    rng = random.Random(1)
    rows = [(k or None, " ".join("".join(rng.choice("bÉé÷") for _ in range(rng.randint(4, 9))) for _ in range(300))) for k in range(40)]
    want = brute(words_of(rows))
    assert len(want) > 300 and max(v[1] for v in want.values()) > 8
    assert found(spark, rows, hot=hot) == want


def test_each_kind_of_edit_at_each_place(spark):
    word = "window"
    variants = {word[:k] + "x" + word[k:] for k in range(7)} | {word[:k] + word[k + 1 :] for k in range(6)} | {word[:k] + "x" + word[k + 1 :] for k in range(6)}
    rows = [(1, " ".join([word] * 9)), *((2, " ".join([v] * 3)) for v in variants)]
    got = found(spark, rows, every=10**9)
    assert got == brute(words_of(rows, every=10**9))
    assert got[word][1] == len(variants) and all(got[v][4] == word for v in variants)


def test_chains_end_in_one_root_and_ties_take_the_first_word(spark):
    chain = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb"]
    rows = [(1, " ".join([w] * (3 * 2**k))) for k, w in enumerate(chain)]
    rows += [(2, " ".join(["zzzzy"] * 8 + ["zzzzx"] * 8 + ["zzzzz"] * 3))]
    got = found(spark, rows, every=10**9)
    assert got == brute(words_of(rows, every=10**9))
    assert got["aaaaaa"][4] == "aabbbb" and got["zzzzz"][2] == "zzzzx"


def test_checksums_take_letters_away(spark):
    rows = [(k, "alphabet Überfluß") for k in range(400)]
    want = words_of(rows, every=3)
    assert len(want) == 2 + 8 + 8
    assert {r.word: r.n for r in vocabulary(spark.createDataFrame(rows, SCHEMA), every=3).collect()} == want


def test_awkward_rows(spark, awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = {r.word: [r.n, r.n_near, r.form, r.form_n, r.root] for r in variant_groups(awkward).collect()}
    assert got == brute(words_of(rows)) and len(got) > 20
    assert variant_groups(nothing).count() == 0


def test_the_query_on_the_small_tables(spark):
    d = "/root/testdata/sf0.001"
    want = brute(words_of(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()))
    got = {r.word: [r.n, r.n_near, r.form, r.form_n, r.root] for r in op13_spelling_variants(spark, d).collect()}
    assert got == want


def test_a_scan_skips_what_is_too_far():
    words = sorted(w.encode() for w in ["abcde", "abcdf", "abxde", "bcdef", "zbcde"])
    size = np.array([len(w) for w in words])
    lists = SortedLists(np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size, size, np.zeros(len(words), int))
    assert lists.lcp.tolist() == [-1, 4, 2, 0, 0]
    pairs = {(words[a], words[b]) for p, q in lists.near(np.arange(len(words))) for a, b in zip(p, q)}
    assert pairs == {(a, b) for a in words for b in words if one_edit(a.decode(), b.decode())}
