"""N-gram Jaccard join by vertical partitioning.

Every distinct n-gram of the corpus has a place in one global order.  The order is cut into fragments, each document's
set is cut with it, and the overlap of a pair is the sum of the overlaps counted in each fragment on its own, so no step
needs a document's set in one piece and long documents spread over many rows.

The way there, for documents that link when ``100 * |a & b| >= percent * |a | b|``:

1. one pass over the texts gives each document its set size, a 64-bit id of the set (equal sets are one class; copies
   are never compared) and the n-grams in a prefix of the order by hash;
2. a class can link only if enough prefix n-grams occur in another class too, so a count of n-grams (pre-aggregated,
   no group is collected) leaves the few classes that may link: the others are done;
3. the n-grams of these classes are put in the global order (octave of document frequency, then hash), those of
   frequency one are dropped and only counted, and the order is cut into fragments;
4. candidates come from the prefixes in that order: in each bucket the class with the fewest rare n-grams is paired with
   the others, pairs are verified by fragment sums, and their components found; then every pair of a bucket that is
   still in two components is verified in the same way.  Pairs already joined need no test, so a group of near copies
   costs as many pairs as it has members and no link between different components is lost.

N-grams are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusproof.llm.components import connected_components
from corpusproof.llm.native import hidden, row_key, shown
from corpusproof.llm.scratch import forget, written
from corpusproof.llm.textbytes import chunks, mix, ngrams


def least_overlap(n, percent: int):
    """The smallest overlap with which a set of size n can still link: ceil(percent * n / 100)."""
    return (n * percent + 99) // 100


def _sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The distinct k-grams of each text in ascending order; with fewer words the whole sequence counts as one."""
    for chunk in chunks(column):
        low = chunk.lowered()
        start, end, first = low.words()
        words = low.hashes(start, end)
        grams, gram_first = ngrams(words, first, k)
        grams = grams.view(np.int64)
        for t in range(chunk.n):
            lo, hi = first[t], first[t + 1]
            if 0 < hi - lo < k:
                whole = np.uint64(hi - lo)
                for h in words[lo:hi]:
                    whole = mix(np.array([whole ^ h]))[0]
                yield np.array([whole]).view(np.int64)
                continue
            own = np.sort(grams[gram_first[t] : gram_first[t + 1]])
            yield own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own


def _set_id(own: np.ndarray) -> int:
    bits = own.view(np.uint64)
    both = np.array([np.add.reduce(mix(bits)), np.bitwise_xor.reduce(bits), np.uint64(len(bits))], np.uint64)
    return int(mix(np.array([mix(both[:1])[0] ^ mix(both[1:2] + both[2:])[0]]))[0].astype(np.int64))


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    at = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64)))


def set_sketches(documents: DataFrame, k: int, percent: int, slack: int) -> DataFrame:
    """(doc_id, key, tie, n, cid, prefix): row_key, set size, set id, and the n-grams that a link must meet ``shared`` times (see below)."""

    def run(batches):
        for batch in batches:
            ns, ids, prefixes = [], [], []
            for own in _sets(batch.column(3), k):
                n = len(own)
                # the smallest partner that can differ has one n-gram more
                keep = n - least_overlap(n, percent) + n * slack // 100 + 1 if 100 * n >= percent * (n + 1) else 0
                ns.append(n)
                ids.append(_set_id(own) if n else 0)
                prefixes.append(own[:keep])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(ns, pa.int64()), pa.array(ids, pa.int64()), _lists(prefixes)], names=["doc_id", "key", "tie", "n", "cid", "prefix"])

    return row_key(documents.select("doc_id", "text")).select(F.col("doc_id").cast("long"), "key", "tie", F.col("text").cast("string")).mapInArrow(run, "doc_id long, key long, tie long, n long, cid long, prefix array<long>")


def _full_sets(documents: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(cid, n, grams) for each wanted class, from the text of its first row (again for rows that repeat it)."""

    def run(batches):
        for batch in batches:
            sets = list(_sets(batch.column(0), k))
            ids = [_set_id(own) if len(own) else 0 for own in sets]
            right = [i for i, (a, b) in enumerate(zip(ids, batch.column(1).to_pylist(), strict=True)) if a == b]
            sets = [sets[i] for i in right]
            yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in right], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), _lists(sets)], names=["cid", "n", "grams"])

    texts = row_key(documents.select("doc_id", F.col("text").cast("string").alias("text")))
    return texts.join(wanted.select("key", "tie", "cid"), ["key", "tie"]).select("text", "cid").mapInArrow(run, "cid long, n long, grams array<long>")


def _may_link(n_a, n_b, most, percent: int):
    """Whether an overlap of ``most`` is enough for sets of these sizes."""
    return (100 + percent) * most >= percent * (n_a + n_b)


def _verified(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, n_a, n_b) whose overlap, summed over the fragments, is enough."""
    left = segments.select(F.col("cid").alias("a"), "fragment", F.col("grams").alias("grams_a"))
    right = segments.select(F.col("cid").alias("b"), "fragment", F.col("grams").alias("grams_b"))
    partial = pairs.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "n_a", "n_b", F.size(F.array_intersect("grams_a", "grams_b")).cast("long").alias("part"))
    total = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("part").alias("overlap"))
    return total.where(_may_link(F.col("n_a"), F.col("n_b"), F.col("overlap"), percent)).select("a", "b", "overlap")


def jaccard_links(documents: DataFrame, k: int = 3, percent: int = 90, slack: int = 5) -> tuple[DataFrame, DataFrame]:
    """(classes, links) of ``documents(doc_id, text)``.

    classes: (doc_id, key, tie, n, cid) for each document, key and tie of row_key, cid the id of its set (0: empty, links with nothing).
    links: (a, b, overlap) between classes; their components are those of all links at this threshold.
    ``slack`` is how many percent of a set the first prefix is longer than the threshold needs.
    """
    sketches = written(set_sketches(documents, k, percent, slack), "sketches")
    classes = sketches.select("doc_id", "key", "tie", "n", "cid")

    tokens = sketches.select("cid", "n", F.explode("prefix").alias("h"))
    shared = tokens.groupBy("h").agg(F.min("cid").alias("lo"), F.max("cid").alias("hi")).where("lo < hi").select("h")
    # a partner may be smaller, down to least_overlap(n), and its prefix then ends sooner
    needed = (least_overlap_column("n", percent) * slack / 100).cast("long") + 1
    alive = tokens.join(shared, "h", "left_semi").groupBy("cid", "n").count().where(F.col("count") >= needed).select("cid")
    first = classes.groupBy("cid").agg(F.min(F.struct("key", "tie")).alias("row")).join(alive, "cid").select("cid", "row.*")
    sets = written(_full_sets(documents, first, k), "sets")

    grams = sets.select("cid", "n", F.explode("grams").alias("h"))
    frequent = grams.groupBy("h").agg(F.count("*").alias("df")).where("df > 1").select("h", F.floor(F.log2("df")).cast("int").alias("octave"))
    ordered = grams.join(frequent, "h").groupBy("cid", "n").agg(F.sort_array(F.collect_set(F.struct("octave", "h"))).alias("grams"))
    ordered = written(ordered.withColumn("c", F.size("grams").cast("long")).where(F.col("c") >= least_overlap_column("n", percent)), "ordered")
    forget(sets)
    fragment = (F.col("g.octave") * 4 + F.shiftrightunsigned("g.h", 62)).cast("int").alias("fragment")
    segments = written(ordered.select("cid", F.explode("grams").alias("g")).select("cid", fragment, F.col("g.h").alias("h")).groupBy("cid", "fragment").agg(F.collect_list("h").alias("grams")), "segments")

    prefix = F.slice("grams", F.lit(1), (F.col("c") - least_overlap_column("n", percent) + 1).cast("int"))
    index = written(ordered.select("cid", "n", "c", F.posexplode(prefix).alias("pos", "g")).select("cid", "n", (F.col("c") - F.col("pos")).alias("rest"), (F.col("n") - F.col("c")).alias("rare"), F.col("g.h").alias("h")), "index")

    forget(ordered)

    def pairs_of(joined: DataFrame) -> DataFrame:
        """Distinct (a, b) with a < b among joined rows x, y whose remaining n-grams still suffice."""
        fit = joined.where(_may_link(F.col("n"), F.col("y.n"), F.least("rest", "y.rest"), percent))
        swap = F.col("cid") > F.col("y.cid")
        return fit.select(F.when(swap, F.col("y.cid")).otherwise(F.col("cid")).alias("a"), F.when(swap, F.col("cid")).otherwise(F.col("y.cid")).alias("b"), F.when(swap, F.col("y.n")).otherwise(F.col("n")).alias("n_a"), F.when(swap, F.col("n")).otherwise(F.col("y.n")).alias("n_b")).distinct()

    pivots = index.groupBy("h").agg(F.count("*").alias("m"), F.min(F.struct("rare", "cid", "n", "rest")).alias("y")).where("m > 1").select("h", "y")
    tested = written(pairs_of(index.join(pivots, "h").where("cid <> y.cid")), "pairs")
    links = written(_verified(tested, segments, percent), "links")

    roots = connected_components(links).toDF("cid", "root")
    plain, index = index, written(index.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid")), "rooted")
    forget(plain)
    by_root = index.groupBy("h", "root").agg(F.count("*").alias("m"))
    main = by_root.groupBy("h").agg(F.max(F.struct("m", "root"))["root"].alias("main"), F.count("*").alias("roots")).where("roots > 1").select("h", "main")
    open_rows = index.join(main, "h")
    outside = open_rows.where("root <> main")
    others = open_rows.select("h", F.struct("cid", "n", "rest", "root").alias("y"))
    across = outside.join(others, "h").where("root <> y.root and (y.root = main or cid < y.cid)")
    rest = pairs_of(across).join(tested.select("a", "b"), ["a", "b"], "left_anti")
    links = links.unionByName(written(_verified(rest, segments, percent), "links"))
    for table in (index, segments, tested):
        forget(table)
    return classes, links


def least_overlap_column(n: str, percent: int):
    return F.floor((F.col(n) * percent + 99) / 100).cast("long")


def jaccard_components(documents: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id, copies, tested_links) for each row of ``documents(doc_id, text)``.

    component_id is the smallest doc_id reachable by links (itself included); class_id is the smallest doc_id with the
    same set, copies their number, tested_links the number of links of the class that had to be verified to find the
    components (not all: pairs already joined through others are not tested, as their number grows with the square of a
    group).  Null and empty texts have an empty set, link with nothing and are their own class and component.  Rows that repeat a doc_id are
    compared by their texts, each on its own.  A null doc_id is kept and its text links like any other; its ids are null unless its class or component has others.
    Other columns are ignored; an empty table gives no rows.
    """
    classes, links = jaccard_links(documents, k, percent)
    size = classes.where("n > 0").groupBy("cid").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("copies"))
    roots = connected_components(links).toDF("cid", "root")
    degree = links.select(F.col("a").alias("cid")).union(links.select("b")).groupBy("cid").agg(F.count("*").alias("tested_links"))
    known = size.join(roots, "cid", "left").join(degree, "cid", "left")
    known = written(known.where("copies > 1 or root is not null").withColumn("root", F.coalesce("root", "cid")), "known")
    component = known.groupBy("root").agg(F.min("class_id").alias("component_id"))
    named = written(known.join(component, "root").select("cid", "class_id", "copies", F.coalesce("tested_links", F.lit(0)).alias("tested_links"), "component_id"), "named")
    return classes.join(named, "cid", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("copies", F.lit(1)).alias("copies"), F.coalesce("tested_links", F.lit(0)).alias("tested_links"))


def one_of_each(documents: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """``documents`` with one row of each component of near duplicates, all columns kept.

    Rows are told apart by doc_id and text; the one with the smallest doc_id (null last), then the smallest hash of its
    text, stays.  Of rows that repeat both, one stays.  Null and empty texts link with nothing and all stay.
    """
    classes, links = jaccard_links(documents, k, percent)
    roots = connected_components(links).toDF("cid", "root")
    rows = classes.where("n > 0").groupBy("cid", "key", "tie").agg(F.count("*").alias("m"), F.first("doc_id").isNull().alias("unnamed"))
    rows = rows.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    groups = rows.groupBy("root").agg(F.min(F.struct("unnamed", "key", "tie")).alias("best"), F.sum("m").alias("members")).where("members > 1")
    lead = (F.col("key") == F.col("best.key")) & (F.col("tie") == F.col("best.tie"))
    grouped = written(rows.join(groups, "root").select("key", "tie", "m", lead.alias("lead")), "grouped")
    keyed = hidden(documents)
    alone = keyed.join(grouped.where("not lead or m > 1").select("key", "tie"), ["key", "tie"], "left_anti")
    repeated = keyed.join(grouped.where("lead and m > 1").select("key", "tie"), ["key", "tie"], "left_semi").dropDuplicates(["key", "tie"])
    return shown(alone.unionByName(repeated), documents)
