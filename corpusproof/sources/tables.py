"""Sources and sinks: ledgers as CSV, inventories and documents as JSON, file trees as lines, rendered documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# fixed values: folders, files and suffixes that are never scanned as text
SKIP_FOLDERS = [".git", "node_modules", "vendor", "dist", "build", "target", ".venv", "venv", "__pycache__", ".terraform", ".idea", ".vscode", ".gradle", "bower_components", ".next", "coverage", "site-packages"]
LOCK_FILES = ["package-lock.json", "yarn.lock", "pnpm-lock.yaml", "poetry.lock", "go.sum", "Cargo.lock", "Gemfile.lock", "composer.lock", "Pipfile.lock"]
BINARY_SUFFIXES = ["png", "jpg", "jpeg", "gif", "ico", "pdf", "zip", "gz", "tar", "jar", "war", "class", "so", "dll", "exe", "bin", "woff", "woff2", "ttf", "eot", "mp4", "mov", "parquet", "avro", "orc", "pyc", "svg", "min.js", "map", "lock"]
MOST_BYTES = 1_000_000
#: Characters at a file's start among which a NUL tells that it is no text.
HEAD_CHARS = 4096


def strings(fields: Sequence[str]) -> StructType:
    return StructType([StructField(f, StringType()) for f in fields])


def read_ledger(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    """A ledger: every column a string, quoted cells may hold line ends, what is missing is empty."""
    return spark.read.csv(path, schema=strings(fields), header=True, multiLine=True, escape='"', quote='"').na.fill("")


def write_ledger(ledger: DataFrame, path: str, fields: Sequence[str]) -> None:
    """Columns in the given order; missing ones empty, others left out."""
    have = set(ledger.columns)
    ledger.select(*(F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) if f in have else F.lit("").alias(f) for f in fields)).write.csv(path, header=True, escape='"', quote='"', emptyValue="")


def read_inventory(spark: SparkSession, path: str, fields: Sequence[str], key: str) -> DataFrame:
    """JSON lines as given fields, with ``problem``: null, or why a line must be refused.

    Blank lines are skipped.  Refused are: broken JSON, unknown fields, a blank key, and status "verified".
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", strings([*fields, "_broken"]), {"columnNameOfCorruptRecord": "_broken", "mode": "PERMISSIVE"}).alias("r"), F.json_object_keys("value").alias("names"))
    unknown = F.array_except(F.coalesce("names", F.array().cast("array<string>")), F.array(*map(F.lit, fields)))
    status = F.col("r.status") if "status" in fields else F.lit(None)
    problem = (
        F.when(F.col("names").isNull() | F.col("r._broken").isNotNull(), "broken JSON")
        .when(F.size(unknown) > 0, F.concat(F.lit("unknown field: "), F.array_join(unknown, ", ")))
        .when(F.trim(F.coalesce(F.col("r")[key], F.lit(""))) == "", F.lit(f"blank {key}"))
        .when(status == "verified", "status verified cannot be set")
    )
    return parsed.select("r.*", problem.alias("problem")).drop("_broken")


def accepted(inventory: DataFrame) -> DataFrame:
    """The inventory's rows; raises at run time if any line must be refused."""
    return inventory.where(F.when(F.col("problem").isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("refused: "), F.col("problem"))).cast("boolean"))).drop("problem")


def read_documents(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """One JSON document per file; ``key`` is the file's name without its suffix."""
    read = spark.read.schema(schema).json(path, multiLine=True)
    return read.select("*", F.regexp_replace(F.col("_metadata.file_name"), "\\.json$", "").alias("key"))


def eligible_file(path, content=None, size=None, most_bytes: int | None = MOST_BYTES):
    """Whether a file is text to be scanned: not in a skipped folder, no lock file, no binary suffix, not over ``most_bytes`` (None: of any size), no NUL near its start."""
    name = F.substring_index(path, "/", -1)
    folders = F.array_intersect(F.slice(F.split(path, "/"), F.lit(1), F.greatest(F.size(F.split(path, "/")) - 1, F.lit(0))), F.array(*map(F.lit, SKIP_FOLDERS)))
    fine = (F.size(folders) == 0) & ~name.isin(LOCK_FILES) & ~F.lower(F.substring_index(name, ".", -1)).isin(BINARY_SUFFIXES) & ~F.lower(name).endswith(".min.js")
    if size is not None and most_bytes is not None:
        fine &= size <= most_bytes
    if content is not None:
        fine &= F.instr(F.substring(content, 1, HEAD_CHARS), F.lit("\x00")) == 0
    return fine


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(repo, path, size, content) below ``path/<repo>/...``, eligible text files only; a row holds a file (``lines.read_lines`` has lines of any file)."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    root = path.rstrip("/").split("://")[-1]
    rest = F.regexp_replace(F.substring_index("path", root + "/", -1), "^/+", "")
    named = raw.select(F.split_part(rest, F.lit("/"), F.lit(1)).alias("repo"), F.regexp_replace(rest, "^[^/]*/", "").alias("path"), F.col("length").alias("size"), F.col("content").cast("string").alias("content"))
    return named.where(eligible_file(F.col("path"), F.col("content"), F.col("size")))


def read_bodies(spark: SparkSession, path: str, suffix: str = "html") -> DataFrame:
    """(page_id, html, size) of the files ``<page_id>.<suffix>`` below ``path``, one whole body each."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{suffix}").load(path)
    return raw.select(F.regexp_extract("path", f"([^/]*)\\.{suffix}$", 1).alias("page_id"), F.col("content").cast("string").alias("html"), F.col("length").alias("size"))


def file_lines(files: DataFrame) -> DataFrame:
    """(repo, path, line, text): lines count from 1; a final line feed leaves one more, empty line."""
    return files.select("repo", "path", F.posexplode(F.split("content", "\\n")).alias("at", "text")).select("repo", "path", (F.col("at") + 1).cast("long").alias("line"), "text")


def walk_order(path):
    """Sort key of a file: those of a folder before those of its sub-folders, each by name."""
    parts = F.split(path, "/")
    return F.transform(parts, lambda p, i: F.concat(F.when(i == F.size(parts) - 1, F.lit("0")).otherwise(F.lit("1")), p))


def attachments_of(listing: DataFrame) -> DataFrame:
    """(page_id, filename, size) from ``listing(page_id, listing)`` with a JSON array of name and size."""
    parsed = F.from_json("listing", "array<struct<filename:string,size:string>>")
    return listing.select("page_id", F.explode(parsed).alias("a")).select("page_id", "a.filename", "a.size")


def flat_entries(entries: DataFrame, sources: DataFrame, kind: str) -> DataFrame:
    """Each entry widened by its source, the source's kind, title and date, ready for ``write.json``."""
    rows = entries.select("source", F.explode("entries").alias("e")).select("e.*", "source")
    return rows.join(sources.select(F.col("key").alias("source"), F.col("title").alias("source_title"), F.col("last_modified").alias("source_last_modified")), "source", "left").withColumn("source_kind", F.lit(kind))


# fixed values: columns of the graph tables
GRAPH_COLUMNS = {
    "edges": ["from_repo", "to_repo", "kind", "identifier", "evidence_from", "evidence_to", "confidence"],
    "pipelines": ["repo", "pipeline", "system", "definition", "trigger_type", "trigger_detail", "trigger_source_repo", "downstream"],
    "nodes": ["repo", "out_degree", "in_degree", "pipelines"],
}


def write_graph(tables: dict[str, DataFrame], folder: str, compression: str = "none") -> None:
    """The given tables of a graph as CSV in their fixed order of columns, each in a folder of its name.

    Edges repeat the same few names, so that ``gzip`` leaves a small part of them; ``read_graph`` reads either.
    """
    for name, rows in tables.items():
        rows.select(*GRAPH_COLUMNS[name]).write.csv(f"{folder}/{name}", header=True, compression=compression)


def read_graph(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table that ``write_graph`` has written, all strings."""
    return read_ledger(spark, f"{folder}/{name}", GRAPH_COLUMNS[name])


def write_references(references: DataFrame, path: str) -> None:
    fields = ["key", "source_kind", "source", "location"]
    references.select(*fields).distinct().orderBy(*fields).write.csv(path, header=True)


def rendered(lines: DataFrame) -> DataFrame:
    """(doc, body) from (doc, seq, line): one text for each document, for documents that fit a row."""
    ordered = F.array_sort(F.collect_list(F.struct("seq", "line")))
    return lines.groupBy("doc").agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("body"))


def write_documents(documents: DataFrame, folder: str) -> None:
    """One text folder for each document."""
    documents.select(F.col("body").alias("value"), "doc").write.partitionBy("doc").text(folder)
