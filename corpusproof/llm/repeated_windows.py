"""Substring dedup by super-k-mers: remove every word covered by a window of words that also starts earlier.

A window is ``WINDOW`` consecutive words of one document.  Its minimiser is the smallest hash among its runs of ``SEED``
words, so equal windows have equal minimisers.  Consecutive windows that share a minimiser travel as one packed string
(a super-k-mer) to the bucket of that minimiser, where the windows are sorted; the one that starts first in (doc_id,
start) stays, the others are marked.

Before anything travels:

* of documents with the same word sequence only the first takes part: every window of the others starts earlier there;
* a minimiser that is selected at a single place of the corpus has no two windows to compare.  Selected places are
  counted (pre-aggregated), and only super-k-mers of minimisers with two or more places are sent.

Minimisers selected at more than ``HOT`` places (a passage in a third of all documents, say) would make a bucket of any
size.  Their windows are keyed by 128-bit hashes of the whole window instead: the earliest start of each is a grouped
minimum, combined before the shuffle, and a plain join marks the later ones.  Windows in buckets are compared by the 64-bit
hashes of all their words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusproof.llm.scratch import written
from corpusproof.llm.textbytes import Chunk, chunks, mix, ngrams

WINDOW = 20
SEED = 5
HOT = 2000
#: Bytes of packed strings that a bucket task sorts at a time, at least one minimiser.
BLOCK = 4 << 20
_NO_ID = -(2**63)


def _sliding(values: np.ndarray, n: int, op) -> np.ndarray:
    """op over n consecutive values, from each place on; the last n - 1 places hold what is left."""
    out, have = values.copy(), 1
    while have < n:
        step = min(have, n - have)
        out[: len(out) - step] = op(out[: len(out) - step], out[step:])
        have += step
    return out


class Windows:
    """Words, window minimisers and selected places of a chunk of texts."""

    def __init__(self, chunk: Chunk, window: int = WINDOW, seed: int = SEED):
        self.start, self.end, self.first = chunk.words()
        self.words = chunk.hashes(self.start, self.end)
        self.seeds, self.seed_first = ngrams(self.words, self.first, seed)
        self.span = window - seed + 1
        least = _sliding(self.seeds, self.span, np.minimum)
        places = np.arange(len(self.seeds)) - np.repeat(self.seed_first[:-1], np.diff(self.seed_first))
        self.valid = places + self.span <= np.repeat(np.diff(self.seed_first), np.diff(self.seed_first))
        self.least = np.where(self.valid, least, np.uint64(0))

    def selected(self) -> np.ndarray:
        """Whether a run of SEED words is the minimiser of some window that holds it."""
        if not len(self.seeds):
            return np.zeros(0, bool)
        most = _sliding(self.least[::-1], self.span, np.maximum)[::-1]
        return most == self.seeds


def _sequence_ids(windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each text's whole word sequence."""
    n = len(windows.words)
    count = np.diff(windows.first)
    place = (np.arange(n) - np.repeat(windows.first[:-1], count)).astype(np.uint64)
    out = []
    for salt in (0x51ED270B7F1B3C25, 0xA0761D6478BD642F):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(windows.words ^ mix(place * np.uint64(2) + np.uint64(salt | 1))))])
        out.append(mix(total[windows.first[1:]] - total[windows.first[:-1]] + count.astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def _keyed(documents: DataFrame) -> DataFrame:
    """doc_id, its key (null: the smallest long), a hash of the text that orders rows with the same doc_id, the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return documents.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(_NO_ID)).alias("key"), F.xxhash64(text).alias("tie"), text.alias("text"))


def _scan(rows: DataFrame, window: int, seed: int) -> DataFrame:
    """(key, tie, n_words, s1, s2, seeds): sequence ids and the selected hashes, each at most twice."""

    def run(batches):
        for batch in batches:
            lo = 0
            for chunk in chunks(batch.column(2)):
                w = Windows(chunk, window, seed)
                s1, s2 = _sequence_ids(w)
                chosen = w.selected()
                parts = []
                for a, b in zip(w.seed_first[:-1], w.seed_first[1:], strict=True):
                    own = np.sort(w.seeds[a:b][chosen[a:b]])
                    keep = np.ones(len(own), bool)
                    keep[2:] = own[2:] != own[:-2]
                    parts.append(own[keep])
                at = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(parts).view(np.int64)))
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, chunk.n) for c in batch.columns[:2]), pa.array(np.diff(w.first)), pa.array(s1), pa.array(s2), lists], names=["key", "tie", "n_words", "s1", "s2", "seeds"])
                lo += chunk.n

    return rows.select("key", "tie", "text").mapInArrow(run, "key long, tie long, n_words long, s1 long, s2 long, seeds array<long>")


def _runs(flags: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of true flags; a true break at a place starts a new run."""
    n = len(flags)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.concatenate([[False], flags[:-1]])
    begin = np.flatnonzero(flags & (~before | breaks))
    after = np.concatenate([~flags[1:] | breaks[1:], [True]])
    end = np.flatnonzero(flags & after)
    return begin, end - begin + 1


def _first_places(h1, h2, key, tie, start) -> tuple[np.ndarray, np.ndarray]:
    """Among windows by their hashes: (the earliest of each, all later ones); repeats of the same place are in neither."""
    order = np.lexsort((start, tie, key, h2, h1))
    same = np.zeros(len(order), bool)
    same[1:] = (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])
    head = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    moved = (key[order] != key[head]) | (tie[order] != tie[head]) | (start[order] != start[head])
    return order[~same], order[same & moved]


def _super_kmers(rows: DataFrame, window: int, seed: int) -> DataFrame:
    """Rows (h, key, tie, start, packed) of wanted minimisers.

    Hot minimisers give instead a row of (h, w2) hashes for each window that is the first of its kind in the task's
    batch, and (start, n) of the runs of windows that are not: those start earlier in the same batch, and need not travel.
    """

    names = ["h", "w2", "key", "tie", "start", "n", "packed"]

    def batch_of(h, w2, key, tie, start, n, packed):
        size = len(h)
        hashes = lambda a: pa.array(a.view(np.int64)) if a is not None else pa.nulls(size, pa.int64())
        return pa.RecordBatch.from_arrays([hashes(h), hashes(w2), pa.array(key), pa.array(tie), pa.array(start), pa.array(n) if n is not None else pa.nulls(size, pa.int64()), pa.array(packed, pa.binary()) if packed is not None else pa.nulls(size, pa.binary())], names=names)

    def run(batches):
        for batch in batches:
            lo, singles = 0, []
            for chunk in chunks(batch.column(2)):
                w = Windows(chunk, window, seed)
                text_of = np.repeat(np.arange(chunk.n), np.diff(w.seed_first))
                sent, hot = np.zeros(len(w.seeds), bool), np.zeros(len(w.seeds), bool)
                for column, flags in ((3, sent), (4, hot)):
                    lists = batch.column(column).slice(lo, chunk.n)
                    values, at = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
                    for k in np.flatnonzero(at[1:] > at[:-1]):
                        a, b = w.seed_first[k], w.seed_first[k + 1]
                        flags[a:b] = np.isin(w.least[a:b], values[at[k] : at[k + 1]]) & w.valid[a:b]
                breaks = np.ones(len(w.seeds), bool)
                breaks[1:] = (w.least[1:] != w.least[:-1]) | (text_of[1:] != text_of[:-1])
                begin, length = _runs(sent, breaks)
                keys, ties = batch.column(0).slice(lo, chunk.n).to_numpy(), batch.column(1).slice(lo, chunk.n).to_numpy()
                text = text_of[begin]
                place = begin - w.seed_first[text]
                word = place + w.first[text]
                packed = [chunk.data[a:b].tobytes() for a, b in zip(w.start[word], w.end[word + length + window - 2], strict=True)]
                yield batch_of(w.least[begin], None, keys[text], ties[text], place, None, packed)
                single = np.flatnonzero(hot)
                if len(single):
                    text = text_of[single]
                    start = single - w.seed_first[text]
                    w1, w_first = ngrams(w.words, w.first, window)
                    w2, _ = ngrams(w.words ^ np.uint64(0x2545F4914F6CDD1D), w.first, window)
                    at = w_first[text] + start
                    singles.append((w1[at], w2[at], keys[text], ties[text], start))
                lo += chunk.n
            if singles:
                columns = [np.concatenate(c) for c in zip(*singles, strict=True)]
                first, later = _first_places(*columns)
                h1, h2, key, tie, start = (c[first] for c in columns)
                yield batch_of(h1, h2, key, tie, start, None, None)
                _, _, key, tie, start = (c[later] for c in columns)
                order = np.lexsort((start, tie, key))
                key, tie, start = key[order], tie[order], start[order]
                breaks = np.ones(len(start), bool)
                breaks[1:] = (key[1:] != key[:-1]) | (tie[1:] != tie[:-1]) | (start[1:] != start[:-1] + 1)
                begin, length = _runs(np.ones(len(start), bool), breaks)
                yield batch_of(np.zeros(len(begin), np.uint64), None, key[begin], tie[begin], start[begin], length, None)

    return rows.select("key", "tie", "text", "seeds", "hot").mapInArrow(run, "h long, w2 long, key long, tie long, start long, n long, packed binary")


def _bucket_marks(sent: DataFrame, window: int) -> DataFrame:
    """(key, tie, start, n): runs of windows that start earlier elsewhere, from super-k-mers sorted by minimiser."""

    def marks(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [[], [], [], []]
        strings = pa.Array.from_buffers(pa.string(), len(batch), batch.column(4).buffers(), 0, batch.column(4).offset)
        for chunk in chunks(strings, 1 << 40):
            start, end, first = chunk.words()
            words = chunk.hashes(start, end)
            grams, gram_first = ngrams(words, first, window)
            row = np.repeat(np.arange(chunk.n), np.diff(gram_first))
            place = np.arange(len(grams)) - gram_first[row]
            key, tie, begin = (batch.column(c).to_numpy()[row] for c in (1, 2, 3))
            begin = begin + place
            order = np.lexsort((begin, tie, key, grams))
            same = np.zeros(len(order), bool)
            same[1:] = grams[order][1:] == grams[order][:-1]
            head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
            again = np.flatnonzero(same)
            word = first[row] + place
            a, b = word[order[again]], word[order[head[again]]]
            alike = np.ones(len(again), bool)
            for j in range(window):
                alike &= words[a + j] == words[b + j]
            again = again[alike]
            # a repeated row is the same place, not a later one
            x, y = order[again], order[head[again]]
            again = again[(key[x] != key[y]) | (tie[x] != tie[y]) | (begin[x] != begin[y])]
            flags = np.zeros(len(grams), bool)
            flags[order[again]] = True
            breaks = np.ones(len(grams), bool)
            breaks[1:] = row[1:] != row[:-1]
            at, length = _runs(flags, breaks)
            for out, values in zip(parts, (key[at], tie[at], begin[at], length), strict=True):
                out.append(values)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(p) if p else np.zeros(0, np.int64)) for p in parts], names=["key", "tie", "start", "n"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.column(4).nbytes
            if size < BLOCK:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            h = table["h"].to_numpy()
            cut = int(np.searchsorted(h, h[-1], "left"))  # the last minimiser may go on in the next batch
            if cut:
                yield marks(table.slice(0, cut).combine_chunks().to_batches()[0])
                held = table.slice(cut).to_batches()
                size = sum(b.column(4).nbytes for b in held)
        if held:
            for batch in pa.Table.from_batches(held).combine_chunks().to_batches():
                yield marks(batch)

    return sent.select("h", "key", "tie", "start", "packed").mapInArrow(run, "key long, tie long, start long, n long")


def remove_repeated_windows(documents: DataFrame, window: int = WINDOW, seed: int = SEED, hot: int = HOT) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) for each row of ``documents(doc_id, text)``.

    Words are runs of characters other than ASCII white space, unchanged; kept words are joined by one space.  Windows
    are judged on the input.  Null and empty texts, and texts shorter than a window, keep all words.  Rows that repeat a
    doc_id with the same text are one document and get the same result; with other texts they are ordered by a hash of
    the text; null doc_ids come before all others.  Other columns are ignored; an empty table gives no rows.
    """
    spark = documents.sparkSession
    rows = _keyed(documents)
    scan = written(_scan(rows, window, seed), "scan")
    sequences = scan.where(F.col("n_words") >= window).groupBy("s1", "s2", "n_words").agg(F.min(F.struct("key", "tie")).alias("head"), F.max(F.struct("key", "tie")).alias("tail"))
    copied = written(sequences.where("head <> tail").select("s1", "s2", "n_words", "head"), "copied")
    later = scan.join(copied, ["s1", "s2", "n_words"]).where("key <> head.key or tie <> head.tie").select("key", "tie").distinct()
    later = written(later, "later")

    ready = scan.join(later, ["key", "tie"], "left_anti").select("key", "tie", F.explode("seeds").alias("h"))
    places = ready.groupBy("h").agg(F.count("*").alias("places")).where("places > 1")
    of_text = ready.join(places, "h").groupBy("key", "tie").agg(F.collect_set(F.when(F.col("places") <= hot, F.col("h"))).alias("seeds"), F.collect_set(F.when(F.col("places") > hot, F.col("h"))).alias("hot"))
    wanted = written(of_text, "wanted")

    sent = _super_kmers(rows.join(wanted, ["key", "tie"]), window, seed)
    sent = written(sent, "super-kmers")
    buckets = sent.where("packed is not null")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    marks = _bucket_marks(buckets.repartition(parts, "h").sortWithinPartitions("h"), window)
    near = sent.where("n is not null").select("key", "tie", "start", "n")
    single = sent.where("w2 is not null").select(F.col("h").alias("w1"), "w2", "key", "tie", "start")
    heads = single.groupBy("w1", "w2").agg(F.min(F.struct("key", "tie", "start")).alias("head"), F.count("*").alias("m")).where("m > 1").select("w1", "w2", "head")
    later_single = single.join(heads, ["w1", "w2"]).where("key <> head.key or tie <> head.tie or start <> head.start").select("key", "tie", "start", F.lit(1).cast("long").alias("n"))
    all_marks = marks.unionByName(near).unionByName(later_single).groupBy("key", "tie").agg(F.collect_list(F.struct("start", "n")).alias("marks"))
    verdicts = written(all_marks.unionByName(later.select("key", "tie", F.lit(None).cast("array<struct<start:bigint,n:bigint>>").alias("marks"))).withColumn("marked", F.lit(True)), "marks")

    def cut(batches):
        for batch in batches:
            texts, marked, lists = batch.column(1), batch.column(2), batch.column(3)
            n_words, n_removed, kept = [], [], []
            for k in range(len(batch)):
                words = texts[k].as_buffer().to_pybytes().split()
                n_words.append(len(words))
                if not marked[k].is_valid:
                    n_removed.append(0)
                elif not lists[k].is_valid:
                    n_removed.append(len(words))
                    words = []
                else:
                    change = np.zeros(len(words) + 1, np.int64)
                    runs = lists[k].values
                    start, n = (runs.field(f).to_numpy() for f in (0, 1))
                    np.add.at(change, start, 1)
                    np.add.at(change, start + n + window - 1, -1)
                    keep = np.cumsum(change[:-1]) == 0
                    n_removed.append(int(len(words) - keep.sum()))
                    words = [words[i] for i in np.flatnonzero(keep)]
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])

    judged = rows.join(verdicts, ["key", "tie"], "left").select("doc_id", "text", "marked", "marks")
    return judged.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_text string")
