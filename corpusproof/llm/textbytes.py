"""Words, lines and hashes of whole texts as numpy arrays over Arrow's UTF-8 buffers.

A chunk is a run of whole texts of about ``CHUNK`` bytes, or a single longer text; no text is ever cut.  Words are
runs of bytes other than ``\\x20 \\x09-\\x0D``, as the contracts of the word-based operators say.  Word hashes are
64-bit polynomial hashes over a random byte table: the sum over a word's bytes of ``table[byte] * r ** position``, taken
from one running sum and divided by ``r ** start`` (``r`` is odd, so it has an inverse modulo 2**64).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_WORD = ~_SPACE
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TABLE = np.random.RandomState(20240229).randint(1, 2**63 - 1, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_R = 0x9E3779B97F4A7C15
_R_INVERSE = pow(_R, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2**64; kept and doubled when a longer text comes."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 2 * CHUNK), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of unsigned 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(32))


class Chunk:
    """Whole texts side by side: ``data`` holds their bytes, text ``k`` is ``data[at[k]:at[k + 1]]``."""

    def __init__(self, data: np.ndarray, at: np.ndarray, first: int):
        self.data, self.at, self.first, self.n = data, at, first, len(at) - 1

    def lowered(self) -> Chunk:
        """A copy with A-Z in lower case; other letters stay as they are."""
        return Chunk(_LOWER[self.data], self.at, self.first)

    def words(self, of: np.ndarray = _WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, text_first): byte range of every word; words of text k are text_first[k]:text_first[k + 1].

        ``of`` tells for each of the 256 bytes whether it belongs to a word.
        """
        word = of[self.data]
        n = len(word)
        if not n:
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(self.n + 1, np.int64)
        before = np.empty(n, bool)
        before[0], before[1:] = False, word[:-1]
        edges = self.at[self.at < n]
        before[edges] = False
        start = np.flatnonzero(word & ~before)
        after = np.empty(n, bool)
        after[-1], after[:-1] = False, word[1:]
        after[edges[edges > 0] - 1] = False
        end = np.flatnonzero(word & ~after) + 1
        return start, end, np.searchsorted(start, self.at)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, text_first) of the pieces between line feeds; an empty text has one empty line."""
        feeds = np.flatnonzero(self.data == 10)
        start = np.concatenate([self.at[:-1], feeds + 1])
        end = np.concatenate([feeds, self.at[1:]])
        text = np.concatenate([np.arange(self.n), np.searchsorted(self.at, feeds, "right") - 1])
        order = np.lexsort((start, text))
        closing = np.concatenate([np.searchsorted(self.at, feeds, "right") - 1, np.arange(self.n)])
        end = end[np.lexsort((end, closing))]
        return start[order], end, np.searchsorted(text[order], np.arange(self.n + 1))

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of the given byte ranges."""
        n = len(self.data)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[self.data] * _power(_R, n), out=total[1:])
        return mix((total[end] - total[start]) * _power(_R_INVERSE, n + 1)[start] + (end - start).astype(np.uint64))


def chunks(texts: pa.Array, limit: int = CHUNK) -> Iterator[Chunk]:
    """Cut an Arrow string column into chunks of whole texts; a null counts as an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if pa.types.is_null(texts.type):
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    n = len(texts)
    if not n:
        return
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, wide, n + 1, texts.offset * np.dtype(wide).itemsize).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    k = 0
    while k < n:
        last = max(k + 1, int(np.searchsorted(at, at[k] + limit, "right")) - 1)
        yield Chunk(data[at[k] : at[last]], at[k : last + 1] - at[k], k)
        k = last


def ngrams(words: np.ndarray, text_first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text_first) of all runs of k words inside one text, from the words' hashes."""
    count = np.diff(text_first)
    n = len(words)
    out_first = np.concatenate([[0], np.cumsum(np.maximum(count - k + 1, 0))])
    if n < k:
        return np.zeros(0, np.uint64), out_first
    total = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        total = (total ^ words[j : n - k + 1 + j]) * np.uint64(0x9DDFEA08EB382D69) + np.uint64(j + 1)
    inside = np.ones(n - k + 1, bool)
    for j in range(1, k):
        # a run that begins in the last k - 1 words of a text leaves it
        edge = text_first[1:][(text_first[1:] - j >= text_first[:-1])] - j
        inside[edge[edge < len(inside)]] = False
    return mix(total[inside]), out_first
