"""The common shape of checks: rows (key, check, ok, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_row(key: Column, check: str, ok: Column, detail: Column | str = "") -> list[Column]:
    shown = F.lit(detail) if isinstance(detail, str) else detail
    return [key.cast("string").alias("key"), F.lit(check).alias("check"), F.coalesce(ok, F.lit(False)).alias("ok"), F.when(F.coalesce(ok, F.lit(False)), F.lit("")).otherwise(F.coalesce(shown.cast("string"), F.lit(""))).alias("detail")]


def check(rows: DataFrame, key: str, name: str, ok: Column, detail: Column | str = "") -> DataFrame:
    return rows.select(*check_row(F.col(key), name, ok, detail))


def checks_of(rows: DataFrame, key: str, named: dict[str, tuple[Column, Column | str]]) -> DataFrame:
    """Several checks of the same rows in one pass."""
    parts = [F.struct(*check_row(F.col(key), name, ok, detail)) for name, (ok, detail) in named.items()]
    return rows.select(F.explode(F.array(*parts)).alias("c")).select("c.*")


def none_of(values: Column, most: int = 5) -> tuple[Column, Column]:
    """For ``checks_of``: passes if the array is empty; the detail is that of ``none_left``."""
    values = F.coalesce(values, F.array().cast("array<string>"))
    first = F.array_join(F.slice(F.array_sort(F.array_distinct(values)), 1, most), ", ")
    return F.size(values) == 0, F.concat_ws(" ", F.size(values).cast("string"), F.lit("missing or wrong:"), first)


def none_left(keys: DataFrame, bad: DataFrame, key: str, name: str, detail: str, most: int = 5) -> DataFrame:
    """A check that passes for each key without rows in ``bad``; its detail lists the first few values of ``detail``."""
    listed = bad.groupBy(key).agg(F.count("*").alias("_n"), F.array_join(F.slice(F.array_sort(F.collect_set(F.col(detail).cast("string"))), 1, most), ", ").alias("_bad"))
    return check(keys.select(key).distinct().join(listed, key, "left"), key, name, F.col("_n").isNull(), F.concat_ws(" ", F.col("_n").cast("string"), F.lit("missing or wrong:"), F.col("_bad")))


def left_out(wanted: DataFrame, have: DataFrame, on: list[str]) -> DataFrame:
    """(*on, n): rows of ``wanted`` without an equal row in ``have``, and how often they come; nulls equal nothing.

    One grouping of both, so that rows which lie by any column of ``on`` stay where they are.
    """
    whole = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in on))
    both = wanted.select(*on, F.lit(False).alias("_have")).unionByName(have.select(*on, F.lit(True).alias("_have")))
    return both.groupBy(*on).agg(F.count_if(~F.col("_have")).alias("n"), F.count_if(F.col("_have") & whole).alias("_have")).where("n > 0 and _have = 0").drop("_have")


def none_left_each(keys: DataFrame, bad: DataFrame, key: str, names: list[str], most: int = 5) -> DataFrame:
    """``none_left`` of several checks in one pass, from ``bad(key, check, detail, n)``."""
    own = lambda name, c: F.when(F.col("check") == name, F.col(c))
    listed = [(F.sum(own(name, "n")).alias(f"_n{name}"), F.array_join(F.slice(F.array_sort(F.collect_set(own(name, "detail").cast("string"))), 1, most), ", ").alias(f"_bad{name}")) for name in names]
    rows = keys.select(key).distinct().join(bad.groupBy(key).agg(*(c for pair in listed for c in pair)), key, "left")
    return checks_of(rows, key, {name: (F.col(f"_n{name}").isNull(), F.concat_ws(" ", F.col(f"_n{name}").cast("string"), F.lit("missing or wrong:"), F.col(f"_bad{name}"))) for name in names})


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
