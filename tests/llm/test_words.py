import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusproof.llm.textbytes import chunks, ngrams


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbZé \n\t\x0b\x1f漢", max_size=20)), max_size=8), st.sampled_from([1, 8, 1000]))
def test_words_lines_and_hashes(texts, limit):
    seen = {}
    for chunk in chunks(pa.array(texts, pa.string()), limit):
        start, end, first = chunk.words()
        hashes = chunk.hashes(start, end)
        line_start, line_end, line_first = chunk.lines()
        grams, gram_first = ngrams(hashes, first, 3)
        for k in range(chunk.n):
            raw = (texts[chunk.first + k] or "").encode()
            words = [bytes(chunk.data[start[i] : end[i]]) for i in range(first[k], first[k + 1])]
            assert words == [w for w in re.split(b"[\x20\x09-\x0d]+", raw) if w]
            assert [bytes(chunk.data[line_start[i] : line_end[i]]) for i in range(line_first[k], line_first[k + 1])] == raw.split(b"\n")
            for i, w in enumerate(words):
                assert seen.setdefault(w, hashes[first[k] + i]) == hashes[first[k] + i]
            runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
            assert len(runs) == gram_first[k + 1] - gram_first[k]
            for i, run in enumerate(runs):
                assert seen.setdefault(run, grams[gram_first[k] + i]) == grams[gram_first[k] + i]
    assert len(set(map(int, seen.values()))) == len(seen)


def test_long_texts_are_whole():
    rng = random.Random(1)
    text = " ".join(rng.choice(["a", "bb", "ccc"]) for _ in range(200_000))
    (chunk,) = chunks(pa.array([text]), 1000)
    assert len(chunk.words()[0]) == 200_000
    assert np.array_equal(np.unique(chunk.hashes(*chunk.words()[:2])).size, 3)
