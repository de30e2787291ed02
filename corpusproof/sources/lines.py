"""Text files as numbered lines, read in splits, and documents of any length written as ordered parts.

No row holds a file or a document here.  A file is read in splits; what a split holds is counted, the counts are summed
along the file, and a line's number is its place in its split and the lines of the splits before.  Documents are sorted by
range: a task writes the lines of its range, so a long document has many parts, which a manifest lists in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusproof.sources.shared import checkpointed, scratch_folder
from corpusproof.sources.tables import HEAD_CHARS, MOST_BYTES, eligible_file

#: Splits that are broadcast to the lines, in at most so many bytes of names; more of them are joined by a shuffle.
SPLITS = 100_000
SPLIT_BYTES = 32 << 20
_BOM = "\ufeff"


def _decoded(name: Column) -> Column:
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def _root(spark: SparkSession, path: str) -> str:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toUri().getPath().rstrip("/")


def _below(root: str, file: Column) -> Column:
    return F.substr(file, F.locate(root + "/", file) + F.lit(len(root) + 1))


def _files(spark: SparkSession, path: str, source: str, wanted: Column | None) -> DataFrame:
    """The rows of a source with name (below ``path``) and size of their file; ``wanted`` speaks of these two."""
    about = F.col("_metadata")
    read = spark.read.option("recursiveFileLookup", True)
    raw = read.text(path, lineSep="\n") if source == "text" else read.format(source).load(path)
    name = _below(_root(spark, path), _decoded(about["file_path"]))
    named = raw.select(name.alias("name"), about["file_size"].alias("size"), *([about["file_block_start"].alias("start"), F.col("value").alias("text")] if source == "text" else []))
    return named if wanted is None else named.where(wanted)


def _stored(spark: SparkSession, path: str, wanted: Column | None) -> DataFrame:
    """(name, size, start, at, bytes, chars, nul, text): lines in the order of reading (``at``) within their splits.

    They are stored before they are counted: another reading may be split otherwise, as splits depend on how many cores
    the cluster has at that time.
    """
    lines = _files(spark, path, "text", wanted).withColumns({"at": F.monotonically_increasing_id(), "bytes": F.octet_length("text") + 1, "chars": F.length("text") + 1, "nul": F.instr("text", F.lit("\x00"))})
    folder = scratch_folder(spark, "lines")
    lines.write.parquet(folder)
    return spark.read.schema(lines.schema).parquet(folder)


def _splits(stored: DataFrame) -> DataFrame:
    """(name, size, start, n, first, bytes) of each split that has lines."""
    return checkpointed(stored.groupBy("name", "size", "start").agg(F.count("*").alias("n"), F.min("at").alias("first"), F.sum("bytes").alias("bytes")))


def _with_marks(splits: DataFrame) -> DataFrame:
    """Add ``bom`` and ``closed``: whether the file begins with a byte order mark, which readers leave out, and ends with a line feed."""
    beyond = F.sum("bytes").over(Window.partitionBy("name")) - F.col("size")
    return splits.withColumns({"bom": beyond.isin(-3, -2), "closed": beyond.isin(-3, 0)})


def _numbered(stored: DataFrame, places: DataFrame) -> DataFrame:
    """The stored lines with the columns of ``places(name, start, first, before, bom, ...)`` and ``line``."""
    size = places.agg(F.count("*").alias("n"), F.sum(F.octet_length("name") + 40).alias("b")).first()
    near = F.broadcast(places) if size.n <= SPLITS and (size.b or 0) <= SPLIT_BYTES else places
    joined = stored.drop("size").join(near, ["name", "start"]).withColumn("line", F.col("before") + F.col("at") - F.col("first") + 1)
    return joined.withColumn("text", F.when(F.col("bom") & (F.col("at") == F.col("first")) & (F.col("start") == 0), F.concat(F.lit(_BOM), F.col("text"))).otherwise(F.col("text")))


def _before(group: str, *order: str) -> Column:
    return F.coalesce(F.sum("n").over(Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def numbered_lines(spark: SparkSession, path: str, wanted: Column | None = None, text_only: bool = False) -> DataFrame:
    """(name, line, text) of the files below ``path``; name is the path from there.

    Lines are cut at line feeds alone and count from 1; a final line feed leaves one more, empty line.  An
    empty file has no lines, since Spark lists none.  ``wanted`` is a condition on ``name`` and ``size``.  With ``text_only`` files with a NUL among their first
    characters are left out.  Files are plain, not compressed; a file may be larger than a split, a line may not be larger
    than memory.
    """
    stored = _stored(spark, path, wanted)
    splits = checkpointed(_with_marks(_splits(stored)).withColumn("before", _before("name", "start")))
    numbered = _numbered(stored, splits)
    lines = numbered.select("name", "line", "text")
    last = splits.where("closed").groupBy("name").agg((F.sum("n") + 1).alias("line")).select("name", "line", F.lit("").alias("text"))
    # a file that is no more than a byte order mark is read as no lines
    blank = _files(spark, path, "binaryFile", wanted).where("size = 3").join(splits.select("name"), "name", "left_anti")
    whole = lines.unionByName(last).unionByName(blank.select("name", F.lit(1).cast("long").alias("line"), F.lit(_BOM).alias("text")))
    if not text_only or stored.where("nul > 0").isEmpty():
        return whole
    # every line has a character, its line feed: a NUL near the start is in one of the first lines
    head = numbered.where(F.col("line") <= HEAD_CHARS).select("name", "line", "chars", "nul").join(stored.where("nul > 0").select("name").distinct(), "name", "left_semi")
    passed = F.sum("chars").over(Window.partitionBy("name").orderBy("line")) - F.col("chars")  # at most HEAD_CHARS rows
    binary = head.withColumn("passed", passed).where((F.col("nul") > 0) & (F.col("passed") + F.col("nul") <= HEAD_CHARS)).select("name").distinct()
    return whole.join(binary, "name", "left_anti")


def read_lines(spark: SparkSession, path: str, most_bytes: int | None = MOST_BYTES) -> DataFrame:
    """(repo, path, line, text) below ``path/<repo>/...``, eligible text files only; without ``most_bytes`` of any size.

    The same rows as ``file_lines(read_files(...))``, but no row holds a whole file.
    """
    inside = F.regexp_replace("name", "^[^/]*/", "")
    lines = numbered_lines(spark, path, eligible_file(inside, size=F.col("size"), most_bytes=most_bytes), text_only=True)
    return lines.select(F.split_part("name", F.lit("/"), F.lit(1)).alias("repo"), inside.alias("path"), "line", "text")


def write_ordered(lines: DataFrame, folder: str) -> DataFrame:
    """Write (doc, seq, line) as text, each document's lines by seq (nulls first) and then by line; returns the manifest.

    ``folder/text/doc=-<doc>/part=<n>/`` holds one file; the parts of a document, by n, are its text with a line feed after
    each line.  ``folder/manifest`` has (doc, part, first_line, lines, bytes) for each file.  The lines of a document lie in
    as many tasks as its share asks for; only lines alike in all three columns share one.  Null lines are left out, a
    null doc is a document of its own (``doc=none``), and no lines give no files.  Line feeds inside a line make more
    lines.  ``lines`` is computed twice, once for the ranges.
    """
    spark = lines.sparkSession
    # never null, so that Spark does not rewrite the column and sort anew
    named = F.coalesce(F.concat(F.lit("-"), F.col("doc").cast("string")), F.lit("none"))
    rows = lines.where("line is not null").select(named.alias("doc"), "seq", F.col("line").alias("value"))
    order = [F.col("doc").asc(), F.col("seq").asc(), F.col("value").asc()]
    ranged = rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    ranged.sortWithinPartitions(order[0], F.col("part").asc(), *order[1:]).select("value", "doc", "part").write.option("maxRecordsPerFile", 0).partitionBy("doc", "part").text(f"{folder}/text", lineSep="\n")
    parts = _files(spark, f"{folder}/text", "text", None).groupBy("name").agg(F.count("*").alias("n"), F.max("size").alias("bytes"))
    parts = _placed(parts).select("doc", "part", (_before("doc", "part") + 1).alias("first_line"), F.col("n").alias("lines"), "bytes")
    parts.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def _placed(files: DataFrame) -> DataFrame:
    """Add ``doc`` and ``part``, as the name of the file tells them."""
    named = _decoded(F.regexp_extract("name", "^doc=([^/]*)/", 1))
    part = F.regexp_extract("name", "/part=([0-9]+)/[^/]*$", 1).cast("int")
    return files.withColumns({"doc": F.when(named != "none", F.substr(named, F.lit(2))), "part": part})


def read_ordered(spark: SparkSession, folder: str) -> DataFrame:
    """(doc, line, text) of ``write_ordered``, lines counted from 1 over all parts; fails if a part has lost lines."""
    parts = spark.read.parquet(f"{folder}/manifest")
    if parts.isEmpty():
        return spark.createDataFrame([], "doc string, line long, text string")
    stored = _stored(spark, f"{folder}/text", None)
    here = _placed(_with_marks(_splits(stored))).withColumn("inside", _before("name", "start")).withColumn("have", F.sum("n").over(Window.partitionBy("name")))
    both = here.alias("h").join(parts.alias("p"), F.col("h.doc").eqNullSafe(F.col("p.doc")) & (F.col("h.part") == F.col("p.part")), "full")
    whole = F.when(F.col("have") == F.col("lines"), F.col("p.first_line") - 1 + F.col("inside")).otherwise(F.raise_error(F.concat_ws(" ", F.lit("lines lost or added:"), F.coalesce("h.doc", "p.doc"), F.coalesce("h.part", "p.part").cast("string"))).cast("long"))
    places = checkpointed(both.select("name", "start", "first", "bom", F.col("h.doc").alias("doc"), whole.alias("before")))
    return _numbered(stored, places).select("doc", "line", "text")
