"""Column expressions over words that stay inside Spark: no Python runs on executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BLANK = " \t\n\x0b\f\r"


def lowered_words(text: Column) -> Column:
    """Lower-cased words between ASCII white space; null and blank texts have none."""
    clean = F.btrim(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(_BLANK))
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, "[ \\t\\n\\x0B\\f\\r]+"))


def word_hashes(text: Column) -> Column:
    return F.transform(lowered_words(text), lambda w: F.xxhash64(w))


def shingle_hashes(hashes: Column, k: int) -> Column:
    """Hashes of all runs of k words, in order, from the words' hashes; fewer words give none."""
    runs = F.transform(F.sequence(F.lit(0), F.greatest(F.size(hashes) - k, F.lit(0))), lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(k))))
    return F.when(F.size(hashes) >= k, runs).otherwise(F.array().cast("array<bigint>"))


def row_key(documents: DataFrame) -> DataFrame:
    """Add ``key`` and ``tie``: the doc_id (null: the smallest long) and a hash of the text, which tell rows apart."""
    return documents.withColumns({"key": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))), "tie": F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))})


def hidden(documents: DataFrame) -> DataFrame:
    """``documents`` with its columns renamed ``own0``, ``own1``, ... and with the columns of ``row_key``: no own name can clash."""
    doc_id, text = (f"own{documents.columns.index(c)}" for c in ("doc_id", "text"))
    renamed = documents.toDF(*(f"own{k}" for k in range(len(documents.columns))))
    return row_key(renamed.withColumns({"doc_id": F.col(doc_id), "text": F.col(text)})).drop("doc_id", "text")


def shown(rows: DataFrame, documents: DataFrame) -> DataFrame:
    """The columns of ``documents`` again, from rows of ``hidden(documents)``."""
    return rows.select(*(F.col(f"own{k}").alias(c) for k, c in enumerate(documents.columns)))


def small(df: DataFrame, rows: int, size: int = 64 << 20) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows in at most ``size`` bytes; beyond, Spark joins it by a shuffle.

    ``df`` is a written table, or a few columns of one, so that Spark knows the size of its files.
    """
    known = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if known <= size and df.limit(rows + 1).count() <= rows else df


def bounded_sample(rows: DataFrame, order: list[str], n: int, chars: int) -> DataFrame:
    """The first ``n`` rows of ``rows`` in this order whose texts have at most ``chars`` characters in all."""
    upto = F.sum(F.length(F.coalesce("text", F.lit("")))).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))  # over n rows
    return rows.orderBy(*order).limit(n).withColumn("upto", upto).where(F.col("upto") <= chars).drop("upto")
