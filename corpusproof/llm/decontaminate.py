"""Benchmark decontamination by SimHash of item-sized windows.

For every size that a benchmark item has, the windows of that many words of a text get a 63-bit SimHash of their words.
Fingerprints are cut into ``BLOCKS`` blocks; two that differ in at most ``RADIUS`` bits differ in at most
``RADIUS // BLOCKS`` bits of one block, so items are listed under all values that close to each of their blocks, and
equal (size, block, bits) keys find every pair within the radius.  Candidates are verified by the exact weighted
similarity of their shingle sets: the weight of a shingle is one over the number of items that have it, and 1 for
shingles of no item; a pair links at ``SIMILARITY`` or more.

A window that shares no five-word shingle with any item has similarity 0 with each.  So texts are cut into runs of
``RUN`` places, and only runs at which a shingle of the benchmark begins have their windows fingerprinted: all windows,
of all sizes and at all places, that hold such a shingle.  Nothing else is left out.

Window sums come from running sums of the words' bits, seven counters of nine bits to a number: the difference of two
running sums is the sum of a window, and adding 255 less half the window's words leaves the majority in each top bit.
Items of more than ``LONGEST`` words are cut into parts of like size, each searched like an item.

Everything is DataFrame expressions, and documents are scanned once.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusproof.llm.native import hidden, row_key, shingle_hashes, shown, small, word_hashes
from corpusproof.llm.scratch import written

SHINGLE = 5
SIMILARITY = 0.8
#: Bits in which fingerprints may differ: a pair at the similarity threshold differs in 8 of 63 on average.
RADIUS = 15
BLOCKS = 6
#: Words of an item, or of a part of one, at most.
LONGEST = 200
#: Places of a text that are looked at together; counters hold up to RUN + 2 * LONGEST, which is less than 512.
RUN = 64
#: Rows of the benchmark's tables up to which they are broadcast, within 64 MB.
BROADCAST = 1_000_000
BITS, FIELD = 63, 9
_ONES = sum(1 << at for at in range(0, BITS, FIELD))
_TOPS = _ONES << (FIELD - 1)


def running_sums(words: Column) -> Column:
    """``FIELD`` arrays: of bits k, k + FIELD, ... of the words' hashes, the sums of the first 0, 1, 2, ... words side by side."""
    start = F.array(F.lit(0).cast("long"))

    def sums(k: int) -> Column:
        bits = F.transform(words, lambda w: F.shiftrightunsigned(w, k).bitwiseAND(F.lit(_ONES)))
        return F.aggregate(bits, start, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    return F.array(*(sums(k) for k in range(FIELD)))


def simhash(sums: list[Column], lo: Column, hi: Column) -> Column:
    """Of words lo to hi - 1: bit i is set where more words have it set than not."""
    total = None
    bias = F.lit(_ONES) * (F.lit(255).cast("long") - F.shiftright(hi - lo, 1))
    for k in range(FIELD):
        most = (F.get(sums[k], hi) - F.get(sums[k], lo) + bias).bitwiseAND(F.lit(_TOPS))
        most = F.shiftrightunsigned(most, FIELD - 1 - k)
        total = most if total is None else total.bitwiseOR(most)
    return F.coalesce(total, F.lit(0).cast("long"))  # never null, so that joins need not look at it twice


def _edges(blocks: int) -> list[int]:
    return [BITS * k // blocks for k in range(blocks + 1)]


def block_keys(fingerprint: Column, size: Column, blocks: int, near: int = 0) -> Column:
    """An array of one number for each block and each value within ``near`` bits of its own: size, block and value side by side."""
    at = _edges(blocks)
    wide = max(b - a for a, b in zip(at[:-1], at[1:], strict=True))

    def own(k: int) -> Column:
        bits = F.shiftrightunsigned(fingerprint, at[k]).bitwiseAND(F.lit((1 << (at[k + 1] - at[k])) - 1))
        return F.shiftleft(size.cast("long") * blocks + k, wide).bitwiseOR(bits)

    def around(k: int) -> Column:
        width = at[k + 1] - at[k]
        masks = [sum(1 << i for i in chosen) for n in range(min(near, width) + 1) for chosen in combinations(range(width), n)]
        return F.transform(F.array(*(F.lit(m).cast("long") for m in masks)), lambda m: own(k).bitwiseXOR(m))

    return F.concat(*map(around, range(blocks))) if near else F.array(*map(own, range(blocks)))


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """(item_id, part, size, words, shingles) of distinct items; those of fewer than five words have no shingle and match nothing."""
    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), word_hashes(F.col("text")).alias("all")).distinct()
    n = F.size("all")
    cuts = F.ceil(n / LONGEST).cast("int")
    begin = lambda i: F.floor(n * i / cuts).cast("int")
    parts = F.transform(F.sequence(F.lit(0), cuts - 1), lambda i: F.struct(i.alias("part"), F.slice("all", begin(i) + 1, begin(i + 1) - begin(i)).alias("words")))
    items = items.where(n >= SHINGLE).select("item_id", F.explode(parts).alias("p")).select("item_id", "p.part", F.size("p.words").alias("size"), "p.words")
    return items.where(F.col("size") >= SHINGLE).withColumn("shingles", F.array_distinct(shingle_hashes(F.col("words"), SHINGLE)))


def linked_windows(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(key, tie, item_id, part, start, size, similarity, distance) of every window that links with an item.

    start counts words from 0; a window may hang over the ends of its text (start below 0, or fewer words than size) as
    long as five words are inside.  key and tie are those of ``row_key``.
    """
    items = written(benchmark_items(benchmark), "items")
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # LONGEST at most
    longest = max(sizes, default=SHINGLE)
    item_shingles = items.select("item_id", "part", F.explode("shingles").alias("s"))
    weights = written(item_shingles.groupBy("s").agg((1.0 / F.countDistinct("item_id")).alias("weight")), "weights")
    prints = items.select("item_id", "part", "size", running_sums(F.col("words")).alias("sums")).select("item_id", "part", "size", simhash([F.col("sums")[k] for k in range(FIELD)], F.lit(0), F.col("size")).alias("item_print"))
    prints = written(prints, "item-prints")
    keys = written(prints.select("item_id", "part", "item_print", F.explode(block_keys(F.col("item_print"), F.col("size"), blocks, radius // blocks)).alias("k")), "item-keys")

    texts = row_key(documents.select("doc_id", "text")).select("key", "tie", word_hashes(F.col("text")).alias("h"))
    shared = texts.select("key", "tie", "h", F.posexplode(shingle_hashes(F.col("h"), SHINGLE)).alias("pos", "s")).join(small(weights.select("s"), BROADCAST), "s", "left_semi")
    at = (F.floor(F.col("pos") / RUN) * RUN).cast("int")
    base = F.greatest(at - longest, F.lit(0))
    runs = shared.select("key", "tie", at.alias("at"), F.size("h").alias("n"), base.alias("base"), F.slice("h", base + 1, F.lit(RUN + 2 * longest)).alias("h"))
    met = written(runs.groupBy("key", "tie", "at").agg(F.first("n").alias("n"), F.first("base").alias("base"), F.first("h").alias("h")), "runs")

    # few rows with much work each: spread them out
    parts = int(met.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = met.repartition(parts, "key", "tie", "at")
    summed = spread.select("key", "tie", "n", "at", "base", running_sums(F.col("h")).alias("sums")).select("key", "tie", "n", "at", "base", *(F.col("sums")[k].alias(f"sums{k}") for k in range(FIELD)))
    sized = summed.select("*", F.explode(F.array(*map(F.lit, sizes)) if sizes else F.array().cast("array<int>")).alias("size"))
    window = ["key", "tie", "start", "size"]
    first = F.greatest(F.col("at") - F.col("size") + SHINGLE, SHINGLE - F.col("size"))
    last = F.least(F.col("at") + RUN - 1, F.col("n") - SHINGLE)
    placed = sized.where(first <= last).select("*", F.explode(F.sequence(first, last)).alias("start"))
    lo = F.greatest(F.col("start"), F.lit(0)) - F.col("base")
    hi = F.least(F.col("start") + F.col("size"), F.col("n")) - F.col("base")
    placed = placed.select(*window, "at", *(f"sums{k}" for k in range(FIELD)), lo.alias("lo"), hi.alias("hi"))
    # a narrow coalesce() to as many partitions ends the generated method here: with the join it is too long for the JVM to compile
    printed = placed.select(*window, "at", simhash([F.col(f"sums{k}") for k in range(FIELD)], F.col("lo"), F.col("hi")).alias("print")).coalesce(parts)
    keyed = printed.select(*window, "at", "print", F.explode(block_keys(F.col("print"), F.col("size"), blocks)).alias("k"))
    distance = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))).alias("distance")
    near = keyed.join(small(keys, BROADCAST), "k").where(distance <= radius).select(*window, "item_id", "part", "at", distance)
    near = written(near.groupBy(*window, "item_id", "part").agg(F.min("at").alias("at"), F.first("distance").alias("distance")), "near")

    # the shingles of a run in order, with their weights and the place in the run where each was last met
    again = F.lag("pos").over(Window.partitionBy("key", "tie", "at", "s").orderBy("pos")).alias("before")
    weighed = spread.select("key", "tie", "at", F.posexplode(shingle_hashes(F.col("h"), SHINGLE)).alias("pos", "s")).join(small(weights, BROADCAST), "s", "left")
    weighed = weighed.select("key", "tie", "at", "pos", "s", F.coalesce("weight", F.lit(1.0)).alias("weight"), again)
    weighed = weighed.groupBy("key", "tie", "at").agg(F.sort_array(F.collect_list(F.struct("pos", "s", "weight", F.coalesce("before", F.lit(-1)).alias("before")))).alias("run"))
    item = ["item_id", "part"]
    item_mass = item_shingles.join(small(weights, BROADCAST), "s").groupBy(*item).agg(F.sum("weight").alias("item_mass"))
    known = written(items.select(*item, "shingles").join(item_mass, item), "weighed-items")
    weight = lambda shingles: F.aggregate(shingles, F.lit(0.0), lambda total, x: total + x["weight"])
    begin = F.greatest(F.col("start"), F.lit(0))
    within = F.slice("run", begin - F.col("base") + 1, F.least(F.col("start") + F.col("size"), F.col("n")) - begin - (SHINGLE - 1))
    pairs = near.join(met.select("key", "tie", "at", "n", "base").join(weighed, ["key", "tie", "at"]), ["key", "tie", "at"]).join(small(known, BROADCAST), item)
    pairs = pairs.select(*window, *item, "distance", "item_mass", "shingles", F.filter(within, lambda x: x["before"] < begin - F.col("base")).alias("own"))
    pairs = pairs.select(*window, *item, "distance", "item_mass", weight(F.col("own")).alias("window_mass"), weight(F.filter("own", lambda x: F.array_contains("shingles", x["s"]))).alias("shared"))
    score = F.col("shared") / (F.col("window_mass") + F.col("item_mass") - F.col("shared"))
    linked = pairs.withColumn("similarity", score).where(F.col("similarity") >= similarity - 1e-9)
    return linked.select("key", "tie", *item, "start", "size", F.round("similarity", 6).alias("similarity"), "distance")


def contaminations(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, start, n_words, similarity, distance, windows) of every text and item of which some window links.

    The window is the most similar one (then the first); windows counts all that link.  start counts words from 0;
    distance is that of the fingerprints.  Null and empty texts, and items without five words, match nothing.  Rows that
    repeat a doc_id with the same text count once.  Null ids: a document keeps its null, an item without an id is passed
    over.  Other columns are ignored; empty tables give no rows.
    """
    linked = linked_windows(documents, benchmark, similarity, radius)
    best = F.max_by(F.struct("start", "size", "similarity", "distance"), F.struct("similarity", -F.col("start"), -F.col("size"))).alias("b")
    found = linked.groupBy("key", "tie", "item_id").agg(best, F.count("*").alias("windows"))
    doc_id = F.when(F.col("key") != -(2**63), F.col("key")).alias("doc_id")
    return found.select(doc_id, "item_id", F.greatest("b.start", F.lit(0)).alias("start"), F.col("b.size").alias("n_words"), "b.similarity", "b.distance", "windows")


def without_contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` in which no window links with an item, all columns kept; each row is judged by its own text.

    Nulls in any column, repeated rows and own columns of any name stay; an empty benchmark or table removes nothing.
    """
    hits = written(linked_windows(documents, benchmark).select("key", "tie").distinct(), "hits")
    return shown(hidden(documents).join(small(hits, BROADCAST), ["key", "tie"], "left_anti"), documents)
