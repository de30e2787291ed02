"""Spelling variants: words of a vocabulary at one edit from each other, grouped under the more frequent ones.

Sorted-list dynamic programming.  A list of words in order is scanned for all its words at once: the row of the edit
matrix that belongs to a prefix (three cells wide, as one edit moves at most one place off the diagonal) is worked out
once and holds for every word of the range that shares the prefix.  Ranges are read off the longest common prefixes (LCP)
of adjacent words: a range of depth d breaks where the LCP is d.  A range whose row holds nothing below two is skipped
with all its words.

The list of the whole vocabulary belongs to no single task, so it is dealt out by halves of words.  One edit leaves the
first half of the shorter word alone, or else its second half, so each pair shares one of them.  Words are listed under
their first half, read forwards, and under their second half, read backwards; each half counts once as the shorter and
once as the longer word of a pair (lengths m and m + 1).  A pair with equal first halves is counted in the first list
only, so counts and best partners of the lists are simply added up, and pairs never leave their task.

The half of more than ``HOT`` words is cut into blocks of asking words; each block scans the whole list of the half.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusproof.llm.native import small
from corpusproof.llm.scratch import written

#: Distinct words that a counting task holds before it passes them on.
HELD = 300_000
#: Words under one half that are scanned in one block.
HOT = 20_000
#: Rows of lists that a task scans at a time, at least one half.
BLOCK = 60_000
#: Words that ask at a time.
ASKING = 10_000
#: What tells lists apart.
LIST = ["half", "m", "backwards", "block"]


def _letters() -> bytes:
    """For each Latin-1 byte: itself if it is a letter of a run (A-Z in lower case), else a space."""
    table = bytearray(b" " * 256)
    for c in (*range(97, 123), *range(0xC0, 0x100)):
        table[c] = c
    for c in range(65, 91):
        table[c] = c + 32
    return bytes(table)


_LETTERS = _letters()


def runs_of(text: str) -> list[bytes]:
    """Maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` with A-Z in lower case, as Latin-1 bytes."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def spelled(run: bytes, start: int, every: int) -> bytes:
    """The run, without one letter if ``every`` divides the checksum of the document's prefix (``start``) and the run."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    if h % every:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1 :]


def vocabulary(documents: DataFrame, least: int = 5, support: int = 3, every: int = 97) -> DataFrame:
    """(word, n) of all words of ``least`` letters or more that occur ``support`` times or more in ``documents(doc_id, text)``.

    A null text has no words; a null doc_id counts as an empty string in the checksum.  Repeated rows count each time.
    """

    def run(batches):
        held: Counter[bytes] = Counter()

        def batch_of():
            words = [w.decode("latin-1") for w in held]
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not text.is_valid:
                    continue
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(runs_of(text.as_py())).items():
                    if len(word) >= least:
                        word = spelled(word, start, every)
                        if len(word) >= least:
                            held[word] += n
                if len(held) >= HELD:
                    yield batch_of()
        if held:
            yield batch_of()

    found = documents.select(F.col("doc_id").cast("string"), F.col("text").cast("string")).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= support)


def common_prefixes(letters: np.ndarray, size: np.ndarray, start: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """The LCP of each word with the one before it; -1 where a new list begins."""
    n = len(start)
    lcp = np.where(fresh, -1, 0)
    going = np.flatnonzero(~fresh)
    depth = 0
    while len(going):
        going = going[np.minimum(size[going], size[going - 1]) > depth]
        going = going[letters[start[going] + depth] == letters[start[going - 1] + depth]]
        depth += 1
        lcp[going] = depth
    return lcp if n else np.zeros(0, np.int64)


class SortedLists:
    """Lists of words side by side, each in order: Latin-1 ``letters``, with ``start``, ``size`` and ``group`` of each word."""

    def __init__(self, letters: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray):
        self.letters, self.start, self.size = letters, start, size
        fresh = np.ones(len(group), bool)
        fresh[1:] = group[1:] != group[:-1]
        self.root = np.maximum.accumulate(np.where(fresh, np.arange(len(group)), 0))
        self.lcp = common_prefixes(letters, size, start, fresh)

    def near(self, asking: np.ndarray):
        """Yield (asking word, word of its list) of all pairs at one edit, for the given places of words."""
        for k in range(0, len(asking), ASKING):
            yield from self._scan(asking[k : k + ASKING])

    def _letter(self, word: np.ndarray, at: int) -> np.ndarray:
        """The letter of each word at a place; 0, which no word holds, outside of it."""
        inside = self.size[word] > at if at >= 0 else np.zeros(len(word), bool)
        return np.where(inside, self.letters[np.where(inside, self.start[word] + at, 0)] if len(self.letters) else 0, 0)

    def _scan(self, asking: np.ndarray):
        # the row of depth d for the asking word q: cost of d letters against d - 1, d and d + 1 letters of q
        q, depth = asking, 0
        level = np.flatnonzero(self.lcp < 0)  # first words of the ranges of this depth
        node = np.searchsorted(level, self.root[asking])
        below, same, above = (np.full(len(q), c, np.int8) for c in (2, 0, 1))
        tall = np.arange(len(self.size))
        while len(q):
            ends = self.size[level[node]] == depth
            cost = np.select([self.size[q] == depth - 1, self.size[q] == depth, self.size[q] == depth + 1], [below, same, above], 2)
            found = ends & (cost == 1)
            if found.any():
                yield q[found], level[node[found]]
            # the ranges one letter deeper: where the LCP breaks, and a word is long enough
            tall = tall[self.size[tall] > depth]
            if not len(tall):
                return
            deeper = tall[self.lcp[tall] <= depth]
            edge = np.searchsorted(deeper, np.append(level, len(self.size)))
            first, last = edge[node], edge[node + 1]
            count = last - first
            total = np.cumsum(count)
            if not total[-1]:
                return
            entry = np.repeat(np.arange(len(q)), count)
            node = np.arange(total[-1]) - np.repeat(total - count, count) + np.repeat(first, count)
            letter = self.letters[self.start[deeper[node]] + depth]
            q = q[entry]
            b, s, a = below[entry], same[entry], above[entry]
            new_below = np.minimum(s + 1, b + (letter != self._letter(q, depth - 1)))
            new_same = np.minimum(np.minimum(a + 1, s + (letter != self._letter(q, depth))), new_below + 1)
            new_above = np.minimum(a + (letter != self._letter(q, depth + 1)), new_same + 1)
            # a cell beyond the end of the asking word is no cell
            size = self.size[q]
            new_same[size < depth + 1] = 2
            new_above[size < depth + 2] = 2
            new_below[size < depth] = 2
            alive = np.minimum(np.minimum(new_below, new_same), new_above) <= 1
            q, node = q[alive], node[alive]
            below, same, above = (np.minimum(x[alive], 2).astype(np.int8) for x in (new_below, new_same, new_above))
            level, depth = deeper, depth + 1


def _listed(words: DataFrame, hot: int) -> DataFrame:
    """(half, m, backwards, block, asks, size, shown, word, n): every word under the four halves by which a pair can find it.

    m is the length of the shorter word of the pairs; the words of that length ask.  A half of more than ``hot`` words
    comes once for each of its blocks, in which a share of them asks.
    """
    size = F.length("word")
    halves = []
    for longer in (0, 1):
        m = size - longer
        cut = F.floor(m / 2).cast("int")
        halves.append(F.struct(F.left("word", cut).alias("half"), m.alias("m"), F.lit(False).alias("backwards")))
        halves.append(F.struct(F.right("word", m - cut).alias("half"), m.alias("m"), F.lit(True).alias("backwards")))
    rows = words.select("word", "n", F.explode(F.array(*halves)).alias("k")).select("k.*", "word", "n")
    large = written(rows.groupBy(*LIST[:3]).agg(F.count("*").alias("words")).where(F.col("words") > hot), "large-halves")
    blocks = F.coalesce(F.ceil(F.col("words") / hot), F.lit(1)).cast("int")
    dealt = rows.join(small(large, 10_000), LIST[:3], "left").withColumn("blocks", blocks).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    asks = (F.length("word") == F.col("m")) & (F.col("block") == F.pmod(F.xxhash64("word"), F.col("blocks")))
    return dealt.select(*LIST, asks.alias("asks"), F.length("word").alias("size"), F.when(F.col("backwards"), F.reverse("word")).otherwise(F.col("word")).alias("shown"), "word", "n")


def _changes(table: pa.Table) -> np.ndarray:
    """Whether each row begins a new list."""
    fresh = np.zeros(len(table), bool)
    fresh[:1] = True
    for c in LIST:
        column = table[c].combine_chunks()
        fresh[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return fresh


def _found(table: pa.Table) -> pa.RecordBatch:
    """(word, n_near, form_n, form) of the words that have near words in the given whole lists, each of which is in order."""
    n, m, size = (table[c].to_numpy().astype(np.int64) for c in ("n", "m", "size"))
    backwards, asks = (table[c].to_numpy() for c in ("backwards", "asks"))
    letters = np.frombuffer("".join(table["shown"].to_pylist()).encode("latin-1"), np.uint8)
    start = np.cumsum(size) - size
    lists = SortedLists(letters, start, size, np.cumsum(_changes(table)))
    words = table["word"].combine_chunks()
    rank = pc.rank(words, sort_keys="ascending", tiebreaker="dense").to_numpy().astype(np.int64)
    near, best = np.zeros(len(n), np.int64), np.full(len(n), -1)
    for a, b in lists.near(np.flatnonzero(asks)):
        fit = (size[b] == m[a]) | (size[b] == m[a] + 1)
        a, b = a[fit], b[fit]
        # pairs with equal first halves are in the first list too
        again = backwards[a].copy()
        for j in range(int(m[a].max(initial=0)) // 2):
            at = np.flatnonzero(again & (m[a] // 2 > j))
            again[at] = letters[start[a[at]] + size[a[at]] - 1 - j] == letters[start[b[at]] + size[b[at]] - 1 - j]
        a, b = a[~again], b[~again]
        longer = size[b] > m[a]  # words of the longer length do not ask
        a, b = np.concatenate([a, b[longer]]), np.concatenate([b, a[longer]])
        np.add.at(near, a, 1)
        by = np.lexsort((rank[b], -n[b], a))
        a, b = a[by], b[by]
        top = np.ones(len(a), bool)
        top[1:] = a[1:] != a[:-1]
        a, b = a[top], b[top]
        better = (best[a] < 0) | (n[b] > n[best[a]]) | ((n[b] == n[best[a]]) & (rank[b] < rank[best[a]]))
        best[a[better]] = b[better]
    out = np.flatnonzero(near)
    return pa.RecordBatch.from_arrays([words.take(pa.array(out)), pa.array(near[out]), pa.array(n[best[out]]), words.take(pa.array(best[out]))], names=["word", "n_near", "form_n", "form"])


def near_words(words: DataFrame, hot: int = HOT) -> DataFrame:
    """(word, n_near, best) of all words of ``words(word, n)`` with a near word; best is struct(n, word) of the most frequent."""
    parts = max(1, int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = _listed(words, hot).repartition(parts, *LIST).sortWithinPartitions(*LIST, "shown")

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) < BLOCK:
                continue
            table = pa.Table.from_batches(held)
            cut = int(np.flatnonzero(_changes(table))[-1])  # the last list may go on in the next batch
            if cut:
                yield _found(table.slice(0, cut))
                held = table.slice(cut).to_batches()
        if held:
            yield _found(pa.Table.from_batches(held))

    found = dealt.mapInArrow(run, "word string, n_near long, form_n long, form string")
    first = F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("best")).select("word", "n_near", F.struct((-F.col("best.n")).alias("n"), "best.word").alias("best"))


def variant_groups(documents: DataFrame, least: int = 5, support: int = 3, every: int = 97, times: int = 2, hot: int = HOT) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of the vocabulary of ``documents(doc_id, text)``.

    Near words differ by one letter inserted, deleted or replaced.  The form of a word is its near word of largest n
    (ties: smallest in code-point order) if that n is ``times`` the word's or more, else null; root is the end of the
    way from form to form, the word itself where it has none.  Null and empty texts have no words, a null doc_id counts
    as an empty string, repeated rows count each time; other columns are ignored; an empty table gives no rows.
    """
    words = written(vocabulary(documents, least, support, every), "vocabulary")
    near = near_words(words, hot)
    form = F.when(F.col("best.n") >= times * F.col("n"), F.col("best"))
    joined = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), form.alias("form"))
    formed = written(joined.select("word", "n", "n_near", F.col("form.word").alias("form"), F.col("form.n").alias("form_n")), "formed")
    return formed.join(_roots(formed), "word", "left").withColumn("root", F.coalesce("root", "word"))


def _roots(formed: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form; each round doubles the way gone, which n bounds by its logarithm."""
    to = written(formed.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        beyond = to.select(F.col("word").alias("root"), F.col("root").alias("next"))
        to, before = written(to.join(beyond, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots"), to
        if not to.where("moved").limit(1).count():
            return to.select("word", "root")
