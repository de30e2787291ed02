"""Phrase collocations by SON partitioning: mine shards at a lowered support, unite what they find, count that exactly.

A phrase that occurs ``support`` times in a language occurs in some shard at least in proportion to the shard's words.  So
every shard is mined completely at ``ceil(support * its words / all words)``; the phrases that are frequent in some shard
are united, and one more pass counts them all in the whole corpus.  There are ``SHARDS`` shards by a hash of the row,
whatever the size of the corpus: a shard belongs to no single task, its counts are combined in each task and then grouped.
A shard that does not report a phrase has it less often than its local support, so what the others report gives an upper
bound too, and phrases that cannot reach the support are no candidates.

Common candidates occur in whatever a task reads, so what the counting pass hands on is about candidates times tasks.  The
candidates grow with the corpus; the tasks do not: there are ``TASKS`` for each core, and each combines all that it reads.

Mining goes by length: a phrase of k words is looked at only where both phrases of k - 1 words inside it are candidates.
Tasks are told the candidates as a bitmap of their hashes, of a fixed size (``BITS``) for any number of candidates; a
phrase whose bit is set by another costs time and no more, since the last pass counts phrases by their words.

The words of a phrase lie in one piece of a text.  Scores are ratios of exact decimals of up to 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusproof.llm.scratch import written
from corpusproof.llm.textbytes import chunks, mix

SHARDS = 4
#: Bits of the map of candidates that goes to every task.
BITS = 1 << 25
#: Bytes of text whose phrases a task combines at a time.
HELD = 4 << 20
#: The same where phrases are told by their words, which are held as well.
TOLD = 2 << 20
#: Bytes of text that go to a task at a time.
BATCH = 4 << 20
#: Tasks of the counting pass for each core, whatever the size of the corpus.
TASKS = 2
#: Phrases whose counts a task of it holds at most, besides those of one batch.
COUNTS = 1 << 19

_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_PIECE_END = np.zeros(256, bool)
_PIECE_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD = ~_PIECE_END
_WORD[[0x20, 0x09]] = False


class _Texts:
    """Words of a chunk of texts: hashes, whether the next word is in the same piece, and the text of each.

    With ``spell`` the words can be told as well.
    """

    def __init__(self, chunk, langs: np.ndarray, shards: np.ndarray, spell: bool):
        low = chunk.lowered()
        start, end, first = low.words(_WORD)
        self.hashes = low.hashes(start, end)
        self.langs, self.shards = langs, shards
        self.text = np.repeat(np.arange(chunk.n, dtype=np.int32), np.diff(first))
        piece = np.cumsum(_PIECE_END[low.data], dtype=np.int32)[start] if len(start) else start
        self.linked = np.zeros(len(start), bool)
        self.linked[:-1] = (piece[1:] == piece[:-1]) & (self.text[1:] == self.text[:-1])
        if spell:
            # words joined by one space each
            word = _WORD[low.data]
            kept = word.copy()
            kept[1:] |= word[:-1]
            place = np.cumsum(kept, dtype=np.int32) - 1
            self.stream = np.where(word, low.data, np.uint8(32))[kept]
            self.start, self.end = (place[start], place[end - 1] + 1) if len(start) else (start, end)

    def keys(self, at: np.ndarray, k: int) -> np.ndarray:
        """Hashes of the phrases of k words that begin at the given words, of their language."""
        total = np.full(len(at), k, np.uint64)
        for j in range(k):
            total = (total ^ self.hashes[at + j]) * np.uint64(0x9DDFEA08EB382D69) + np.uint64(j + 1)
        return mix(total ^ self.langs[self.text[at]])

    def phrases(self, maps: list[np.ndarray], k: int, upto: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, first words, hashes) of phrases of k words, or with ``upto`` of 2 to k, all of whose parts are in ``maps``."""
        at = np.arange(len(self.hashes))
        for j in range(1, k + 1):
            if j > 1:
                # both phrases one word shorter are candidates, and the last word is in the same piece
                known = np.zeros(len(self.hashes) + 1, bool)
                known[at] = True
                at = at[known[at + 1] & self.linked[at + j - 2]]
            key = self.keys(at, j)
            if j <= len(maps):
                spot = ((key >> np.uint64(2)) & np.uint64(64 * len(maps[j - 1]) - 1)).astype(np.int64)
                found = (maps[j - 1][spot >> 6] >> (spot & 63).astype(np.uint64)) & np.uint64(1) > 0
                at, key = at[found], key[found]
            if j == k or upto and j > 1:
                yield j, at, key


def _slices(stream: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The given byte ranges as strings."""
    size = end - start
    at = np.concatenate([[0], np.cumsum(size)])
    spot = np.arange(at[-1]) - np.repeat(at[:-1], size) + np.repeat(start, size)
    return pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(stream[spot])])


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Texts reach the tasks in batches of ``BATCH`` bytes or little more: JVM and worker hold two or three of them, for each core."""
    before = spark.conf.get(_BATCH_BYTES, None)
    spark.conf.set(_BATCH_BYTES, str(BATCH))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH_BYTES)
        else:
            spark.conf.set(_BATCH_BYTES, before)


def _held(batches, spell: bool) -> Iterator[list[_Texts]]:
    """Texts of batches (lang_key, shard, text), about ``HELD`` bytes at a time, or ``TOLD`` if words are told."""
    texts, size = [], 0
    for batch in batches:
        langs, shards = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
        for chunk in chunks(batch.column(2)):
            own = slice(chunk.first, chunk.first + chunk.n)
            texts.append(_Texts(chunk, langs[own], shards[own], spell))
            size += len(chunk.data)
            if size >= (TOLD if spell else HELD):
                yield texts
                texts, size = [], 0
    if texts:
        yield texts


_COUNTED = ["lang_key", "key", "phrase", "n"]


def _counted(texts: list[_Texts], found: list[tuple[int, int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """(lang_key, key, phrase, n) of phrases found as (text, length, first words, hashes)."""
    moved = np.cumsum([0, *(len(t.stream) for t in texts)])
    key = np.concatenate([f[3] for f in found])
    start = np.concatenate([texts[t].start[at] + np.int32(moved[t]) for t, _, at, _ in found])
    end = np.concatenate([texts[t].end[at + k - 1] + np.int32(moved[t]) for t, k, at, _ in found])
    lang = np.concatenate([texts[t].langs[texts[t].text[at]] for t, _, at, _ in found])
    key, one, n = np.unique(key, return_index=True, return_counts=True)
    stream = np.concatenate([t.stream for t in texts])
    return pa.RecordBatch.from_arrays([pa.array(lang[one].view(np.int64)), pa.array(key.view(np.int64)), _slices(stream, start[one], end[one]), pa.array(n)], names=_COUNTED)


def _combined(counts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts (sorted by key, each key once in a batch) added up over batches, handed on as soon as there are ``COUNTS``.

    They are found by key and added up by words: a phrase whose key another one has stays apart.
    """
    kept = None
    for batch in counts:
        key, more = batch.column("key").to_numpy().view(np.uint64), batch.column("n").to_numpy()
        if kept is None or not len(kept):
            kept, keys, n = batch, key, more.copy()
        else:
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            same = pc.and_(*(pc.equal(kept.column(c).take(pa.array(at)), batch.column(c)) for c in ("lang_key", "phrase")))
            known = (keys[at] == key) & same.to_numpy(zero_copy_only=False)
            n[at[known]] += more[known]
            if not known.all():
                keys, n = np.concatenate([keys, key[~known]]), np.concatenate([n, more[~known]])
                order = np.argsort(keys, kind="stable")
                both = pa.Table.from_batches([kept, batch.filter(pa.array(~known))])
                kept, keys, n = both.take(pa.array(order)).combine_chunks().to_batches()[0], keys[order], n[order]
        if len(kept) >= COUNTS:
            yield kept.set_column(3, "n", pa.array(n))
            kept = None
    if kept is not None:
        yield kept.set_column(3, "n", pa.array(n))


def _words(rows: DataFrame) -> DataFrame:
    """(lang_key, phrase, key, shard, n): counts of words (shard null), and of all words of each shard (phrase null)."""

    def run(batches):
        for texts in _held(batches, True):
            every = [(t, 1, at := np.arange(len(x.hashes)), x.keys(at, 1)) for t, x in enumerate(texts)]
            words = _counted(texts, every)
            yield pa.RecordBatch.from_arrays([*words.columns, pa.nulls(len(words), pa.int32())], names=[*_COUNTED, "shard"])
            counts = [np.bincount(x.text, minlength=len(x.langs)) for x in texts]
            pairs = np.concatenate([np.stack([x.langs.view(np.int64), x.shards.astype(np.int64)]) for x in texts], axis=1)
            each, which = np.unique(pairs, axis=1, return_inverse=True)
            n = np.bincount(which.ravel(), np.concatenate(counts)).astype(np.int64)
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(each[0]), none, none.cast(pa.string()), pa.array(n), pa.array(each[1], pa.int32())], names=[*_COUNTED, "shard"])

    found = rows.mapInArrow(run, "lang_key long, key long, phrase string, n long, shard int")
    return found.groupBy("lang_key", "phrase", "shard").agg(F.any_value("key").alias("key"), F.sum("n").alias("n"))


def _mined(rows: DataFrame, maps: list[_Map], k: int) -> DataFrame:
    """(lang_key, shard, key, n): phrases of k words whose parts are candidates, counted by shard."""

    def run(batches):
        known = [m.spread() for m in maps]
        last = np.uint64(SHARDS - 1)
        for texts in _held(batches, False):
            found = [(x, at, key) for x in texts for _, at, key in x.phrases(known, k)]
            # the shard takes the place of the last bits, which no map looks at
            own = np.concatenate([(key & ~last) | x.shards[x.text[at]].astype(np.uint64) for x, at, key in found])
            lang = np.concatenate([x.langs[x.text[at]] for x, at, _ in found])
            del found, texts
            own, one, n = np.unique(own, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(lang[one].view(np.int64)), pa.array((own & last).astype(np.int32)), pa.array((own & ~last).view(np.int64)), pa.array(n)], names=["lang_key", "shard", "key", "n"])

    # each task has combined what it holds; once more before the shuffle would only take memory
    found = rows.mapInArrow(run, "lang_key long, shard int, key long, n long").repartition("key")
    return found.groupBy("lang_key", "shard", "key").agg(F.sum("n").alias("n"))


@dataclass
class _Map:
    """A bitmap of hashes (all but their last two bits) of ``BITS`` bits, whatever their number; only words with a bit travel."""

    at: np.ndarray
    bits: np.ndarray
    size: int

    @staticmethod
    def of(keys: DataFrame) -> _Map:
        spot = F.shiftrightunsigned("key", 2).bitwiseAND(F.lit(BITS - 1))
        rows = keys.select(spot.alias("spot")).groupBy(F.shiftright("spot", 6).cast("int").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(spot & 63 AS INT))")).alias("bits")).toArrow()
        return _Map(rows["at"].to_numpy(), rows["bits"].to_numpy(), BITS >> 6)

    def spread(self) -> np.ndarray:
        out = np.zeros(self.size, np.uint64)
        out[self.at] = self.bits.view(np.uint64)
        return out


def _ranked(words: DataFrame, phrases: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """The best phrases of each language, from counts (lang_key, phrase, n) of words and of phrases."""
    known = words.unionByName(phrases)
    size = F.size("words")
    part = lambda first, n: F.array_join(F.slice("words", first, n), " ")
    split = phrases.select("lang_key", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    # one of as many occurrences that is longer by several words holds one that is longer by a word and has as many
    inside = split.where(size > 2).select("lang_key", "a", F.explode(F.array(part(1, size - 1), part(2, size - 1))).alias("phrase"))
    inside = inside.groupBy("lang_key", "phrase").agg(F.max("a").alias("longer"))
    alone = split.join(inside, ["lang_key", "phrase"], "left").where("longer is null or longer < a")
    cuts = alone.select("lang_key", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("cut"))
    cuts = cuts.select("lang_key", "phrase", "a", "cut", part(1, F.col("cut")).alias("first"), part(F.col("cut") + 1, size - F.col("cut")).alias("rest"))
    cuts = cuts.join(known.select("lang_key", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang_key", "first"])
    cuts = cuts.join(known.select("lang_key", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang_key", "rest"]).join(totals, "lang_key")
    score = F.expr("CAST(1000 AS DECIMAL(4)) * CAST(a AS DECIMAL(15)) * CAST(n AS DECIMAL(18)) div (CAST(l AS DECIMAL(18)) * CAST(r AS DECIMAL(18)))")
    lowest = cuts.withColumn("score", score).groupBy("lang_key", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
    rank = F.row_number().over(Window.partitionBy("lang_key").orderBy(F.desc("low.score"), F.desc("a"), "phrase"))
    return lowest.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)


def collocations(documents: DataFrame, longest: int = 5, support: int = 100, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, cut) of ``documents(lang, text)``: each language's best phrases of 2 to ``longest`` words.

    Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and at spaces and tabs into words.  n counts
    a language's words, a a phrase's occurrences within pieces (overlaps included), at least ``support``.  The cut after
    the first ``cut`` words gives l and r, the occurrences of the first and the other words, and the score
    ``floor(1000 * a * n / (l * r))``; the lowest-scoring cut counts (ties: the smallest).  A phrase that lies in a longer
    one of as many occurrences is left out.  Ranks go by score and a, both falling, and phrase.

    A null language is ``und``.  Null and empty texts have no words; repeated rows count each time; other columns are
    ignored; an empty table gives no rows.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.xxhash64(lang).alias("lang_key"), F.pmod(F.xxhash64(text), F.lit(SHARDS)).cast("int").alias("shard"), text.alias("text"))
    names = documents.select(F.xxhash64(lang).alias("lang_key"), lang.alias("lang")).distinct()

    with _small_batches(documents.sparkSession):
        counted = written(_words(rows), "words")
        words = counted.where(F.col("phrase").isNotNull() & (F.col("n") >= support)).select("lang_key", "phrase", "key", "n")
        totals = written(counted.where("phrase is null").select("lang_key", "shard", F.col("n").alias("own")).withColumn("n", F.sum("own").over(Window.partitionBy("lang_key"))), "totals")  # a row for each shard
        local = totals.select("lang_key", "shard", F.expr(f"({support} * own + n - 1) div n").alias("least"))
        unseen = local.groupBy("lang_key").agg(F.sum(F.col("least") - 1).alias("unseen"))

        maps = [_Map.of(words)]
        for k in range(2, longest + 1):
            frequent = _mined(rows, maps, k).join(local, ["lang_key", "shard"]).where("n >= least")
            reported = frequent.groupBy("lang_key", "key").agg(F.sum(F.col("n") - F.col("least") + 1).alias("over"))
            united = written(reported.join(unseen, "lang_key").where(F.col("over") + F.col("unseen") >= support).select("key"), "united")
            maps.append(_Map.of(united))
            if not len(maps[-1].at):
                break

        def count(batches):
            known = [m.spread() for m in maps]
            yield from _combined(_counted(texts, [(t, j, at, key) for t, x in enumerate(texts) for j, at, key in x.phrases(known, len(known), upto=True)]) for texts in _held(batches, True))

        few = rows.coalesce(TASKS * rows.sparkSession.sparkContext.defaultParallelism)
        counts = few.mapInArrow(count, "lang_key long, key long, phrase string, n long").groupBy("lang_key", "phrase").agg(F.sum("n").alias("n"))
        phrases = written(counts.where(F.col("n") >= support), "phrases")
    best = _ranked(words.select("lang_key", "phrase", "n"), phrases, totals.select("lang_key", "n").distinct(), top)
    return best.join(names, "lang_key").select("lang", "rank", "phrase", "a", "low.l", "low.r", "n", "low.score", "low.cut")
