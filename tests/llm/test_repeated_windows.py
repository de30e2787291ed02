import random
import re
from collections import Counter

import pytest

from corpusproof.llm.repeated_windows import remove_repeated_windows


def brute(rows, size):
    seen, out = set(), {}
    for d, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        words = [w for w in re.split("[\x20\x09-\x0d]+", t or "") if w]
        gone = set()
        for k in range(len(words) - size + 1):
            window = tuple(words[k : k + size])
            if window in seen:
                gone.update(range(k, k + size))
            seen.add(window)
        out[d] = (len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone))
    return Counter((d, *out[d]) for d, _ in rows)


def same(df, size, seed, hot):
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in remove_repeated_windows(df, size, seed, hot).collect())
    assert got == brute([(r.doc_id, r.text) for r in df.collect()], size)


@pytest.mark.parametrize("hot", [2, 2000])
def test_awkward_rows(awkward, nothing, hot):
    same(awkward, 20, 5, hot)
    assert remove_repeated_windows(nothing).count() == 0


@pytest.mark.parametrize("hot", [1, 4, 2000])
def test_random_repeats(spark, hot):
    rng = random.Random(6)
    rows = []
    for d in range(60):
        words = [rng.choice("abcd") for _ in range(rng.randint(0, 60))]
        if d % 4 == 0:
            words += ["x"] * rng.randint(1, 40)
        rows.append((d, " ".join(words)))
    rows += [(100 + d, rows[d][1]) for d in range(0, 60, 5)]
    same(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 6, 2, hot)
