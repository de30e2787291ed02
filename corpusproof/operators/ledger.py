"""The keyed ledger: merges, retries, batches, differences.

A ledger is a DataFrame of strings whose first column is the key; it always has ``status``, ``attempts`` and ``notes``.
``row_no`` carries ledger order where order matters.  Every operator returns a new DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from corpusproof.functions.text import squeeze, text_of
from corpusproof.sources.shared import checkpointed
from corpusproof.sources.tables import strings

REQUIRED = ("status", "attempts", "notes")
OPEN = ("pending", "done", "failed")
MOST_ATTEMPTS = 3


def empty_ledger(spark: SparkSession, fields: Sequence[str]) -> DataFrame:
    """No rows; the required columns are added where absent."""
    return spark.createDataFrame([], strings([*fields, *(c for c in REQUIRED if c not in fields)]))


def create_ledger(spark: SparkSession, path: str, fields: Sequence[str]) -> None:
    """Write an empty ledger; fails where one exists."""
    empty_ledger(spark, fields).write.mode("errorifexists").csv(path, header=True)


# ---- selection ----


def matching(ledger: DataFrame, where: Mapping[str, str]) -> DataFrame:
    """Rows in which every given field equals its value; an unknown field is an error."""
    for field, value in where.items():
        ledger = ledger.where(text_of(ledger[field]) == value)
    return ledger


def chosen(ledger: DataFrame, key: str, ids: Sequence[str] | None = None, statuses: Sequence[str] | None = None, final: bool = False) -> DataFrame:
    """Rows by key list, by status, or (final) those that are done or verified."""
    if ids is not None:
        return ledger.where(F.col(key).isin(list(ids)))
    return ledger.where(F.col("status").isin(["done", "verified"] if final else list(statuses or OPEN)))


def unknown_keys(ledger: DataFrame, requested: DataFrame, key: str) -> DataFrame:
    return requested.select(key).join(ledger.select(key), key, "left_anti")


def require_keys(ledger: DataFrame, requested: DataFrame, key: str) -> None:
    """Raise if a requested key is not in the ledger."""
    missing = [r[0] for r in unknown_keys(ledger, requested, key).limit(5).collect()]
    if missing:
        raise KeyError(f"not in the ledger: {', '.join(map(str, missing))}")


def projected(ledger: DataFrame, fields: Sequence[str]) -> DataFrame:
    have = set(ledger.columns)
    return ledger.select(*(text_of(F.col(f)).alias(f) if f in have else F.lit("").alias(f) for f in fields))


def next_batch(ledger: DataFrame, n: int = 10, statuses: Sequence[str] = ("failed", "pending"), where: Mapping[str, str] | None = None, order: str = "row_no") -> DataFrame:
    """The first n rows in the order of the statuses, then ledger order."""
    place = F.array_position(F.array(*map(F.lit, statuses)), F.col("status"))
    return matching(ledger, where or {}).where(F.col("status").isin(list(statuses))).orderBy(place, order).limit(n)


def live(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("status") != "removed_at_source")


def seeded(source: DataFrame, key: str, wanted: str = "verified", file_field: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows to seed from, rows left out with their reason)."""
    reason = F.when(F.col("status") != wanted, F.concat(F.lit("source status is '"), F.col("status"), F.lit("'")))
    if file_field:
        reason = reason.when(text_of(F.col(file_field)) == "", F.lit("file missing"))
    judged = source.withColumn("reason", reason)
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null").select(key, "reason")


def sample_verified(ledger: DataFrame, n: int, seed: int) -> DataFrame:
    """n verified rows at random, the same for the same seed and input."""
    return ledger.where(F.col("status") == "verified").orderBy(F.xxhash64(F.lit(seed), F.col(ledger.columns[0])), ledger.columns[0]).limit(n)


def pilot_pages(ledger: DataFrame, largest: int = 4, more: int = 5) -> DataFrame:
    """The first root, the pages with most attachments, and the next ones in ledger order."""
    count = F.coalesce(F.col("attachment_count").try_cast("int"), F.lit(0))
    ranked = ledger.withColumn("_count", count)
    root = ranked.where(text_of(F.col("parent_id")) == "").orderBy("row_no").limit(1)
    rest = ranked.join(root.select("page_id"), "page_id", "left_anti")
    top = rest.orderBy(F.desc("_count"), "row_no").limit(largest)
    tail = rest.join(top.select("page_id"), "page_id", "left_anti").orderBy("row_no").limit(more)
    return root.unionByName(top).unionByName(tail).drop("_count")


def largest_by(rows: DataFrame, count: str, key: str, n: int = 5) -> DataFrame:
    """The n rows with the largest count; ties by key."""
    return rows.orderBy(F.desc(F.col(count).try_cast("bigint")), key).limit(n)


# ---- updates ----


def appended_note(notes: Column, note: Column) -> Column:
    """Notes with one more, white space collapsed, joined by `` | ``; a blank note changes nothing."""
    clean = squeeze(note)
    return F.when(clean == "", text_of(notes)).when(text_of(notes) == "", clean).otherwise(F.concat(text_of(notes), F.lit(" | "), clean))


def merged(ledger: DataFrame, inventory: DataFrame, key: str, update: bool = False) -> DataFrame:
    """Insert new rows (pending, 0 attempts, other fields empty); with ``update`` present fields overwrite old rows.

    The inventory must have one row for each key (see ``first_of_each``); its null fields count as absent.  Adds
    ``merge`` = added, updated or skipped to the inventory's rows; other rows have null there.
    """
    fields = [c for c in ledger.columns if c != key]
    given = set(inventory.columns)
    old, new = ledger.alias("old"), inventory.withColumn("_new", F.lit(True)).alias("new")
    joined = old.withColumn("_old", F.lit(True)).alias("old").join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    fresh = F.col("old._old").isNull()
    defaults = {"status": "pending", "attempts": "0"}

    def value(field: str) -> Column:
        start = F.lit(defaults.get(field, ""))
        if field not in given:
            return F.when(fresh, start).otherwise(F.col(f"old.{field}"))
        seen = F.col(f"new.{field}")
        inserted = F.coalesce(seen.cast("string"), start) if field not in defaults or update else F.coalesce(F.nullif(seen.cast("string"), F.lit("")), start)
        kept = F.coalesce(seen.cast("string"), F.col(f"old.{field}")) if update else F.col(f"old.{field}")
        return F.when(fresh, inserted).otherwise(kept)

    outcome = F.when(fresh, "added").when(F.col("new._new"), F.lit("updated" if update else "skipped"))
    return joined.select(F.coalesce(F.col(f"old.{key}"), F.col(f"new.{key}")).alias(key), *(value(f).alias(f) for f in fields), outcome.alias("merge"))


def first_of_each(inventory: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each key, the first in the given order."""
    best = inventory.groupBy(key).agg(F.min_by(F.struct(*(c for c in inventory.columns if c != key)), order).alias("_r"))
    return best.select(key, "_r.*").select(*inventory.columns)


def last_fields_of_each(inventory: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each key; every field is the last one given that is not null."""
    rest = [c for c in inventory.columns if c not in (key, order)]
    return inventory.groupBy(key).agg(*(F.max_by(F.struct(F.col(c)), F.when(F.col(c).isNotNull(), F.col(order)))[c].alias(c) for c in rest))


def merge_summary(rows: DataFrame) -> DataFrame:
    return rows.agg(*(F.count_if(F.col("merge") == m).alias(m) for m in ("added", "updated", "skipped")), F.count("*").alias("total"))


def with_fields(ledger: DataFrame, keys: DataFrame, key: str, values: Mapping[str, str]) -> DataFrame:
    """Set fields of the listed keys; ``notes`` is appended.  Unknown keys or fields, and status "verified", are errors."""
    if values.get("status") == "verified":
        raise ValueError("status verified is set by a check only")
    if unknown := set(values) - set(ledger.columns):
        raise KeyError(f"unknown field: {', '.join(sorted(unknown))}")
    require_keys(ledger, keys, key)
    marked = ledger.join(keys.select(key).distinct().withColumn("_hit", F.lit(True)), key, "left")
    new = {f: F.when(F.col("_hit"), appended_note(F.col("notes"), F.lit(v)) if f == "notes" else F.lit(v)).otherwise(F.col(f)) for f, v in values.items()}
    return marked.withColumns(new).select(*ledger.columns)


def bulk_set(ledger: DataFrame, where: Mapping[str, str], values: Mapping[str, str]) -> DataFrame:
    """Set fields, notes too, of all rows that match; status "verified" and unknown fields are errors."""
    if values.get("status") == "verified":
        raise ValueError("status verified is set by a check only")
    if unknown := (set(values) | set(where)) - set(ledger.columns):
        raise KeyError(f"unknown field: {', '.join(sorted(unknown))}")
    hit = F.lit(True)
    for field, value in where.items():
        hit &= text_of(F.col(field)) == value
    return ledger.withColumns({f: F.when(hit, F.lit(v)).otherwise(F.col(f)) for f, v in values.items()})


def failure(now: Column, note: Column, most: int = MOST_ATTEMPTS) -> dict[str, Column]:
    """Columns of a failed row: one more attempt, needs_human from the last allowed one on, a note with the time."""
    tries = F.coalesce(F.col("attempts").try_cast("int"), F.lit(0)) + 1
    stamped = F.concat(F.date_format(now, "yyyy-MM-dd HH:mm"), F.lit(" "), squeeze(note))
    return {"attempts": tries.cast("string"), "status": F.when(tries >= most, "needs_human").otherwise("failed"), "notes": appended_note(F.col("notes"), stamped)}


def success(now: Column, fields: Sequence[str]) -> dict[str, Column]:
    done = {"status": F.lit("verified")}
    if "verified_at" in fields:
        done["verified_at"] = F.date_format(now, "yyyy-MM-dd HH:mm")
    return done


def verdicts(checks: DataFrame) -> DataFrame:
    """(key, ok, failing) from (key, check, ok, detail): failing checks with their details, joined by ``; ``."""
    failing = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("ok"), F.struct("check", "detail")))), lambda x: F.concat_ws(": ", x["check"], F.nullif(x["detail"], F.lit("")))), "; ")
    return checks.groupBy("key").agg(F.bool_and("ok").alias("ok"), failing.alias("failing"))


def with_verdicts(ledger: DataFrame, judged: DataFrame, key: str, now: Column, most: int = MOST_ATTEMPTS, check_only: bool = False) -> DataFrame:
    """Apply (key, ok, failing): passed rows become verified, failed ones are counted; with check_only nothing changes."""
    if check_only:
        return ledger
    joined = ledger.join(judged.select(F.col("key").alias(key), "ok", "failing"), key, "left")
    bad, good = failure(now, F.col("failing"), most), success(now, ledger.columns)
    changed = {f: F.when(F.col("ok"), good[f]).otherwise(F.col(f)) if f in good else F.col(f) for f in {*bad, *good}}
    changed = {f: F.when(~F.coalesce("ok", F.lit(True)), bad[f]).otherwise(v) if f in bad else v for f, v in changed.items()}
    return joined.withColumns(changed).select(*ledger.columns)


def with_entry_outcomes(ledger: DataFrame, judged: DataFrame, entries: DataFrame, key: str, now: Column) -> DataFrame:
    """As ``with_verdicts``; passed rows also get verdict and entry counts, and verdict needs_human moves the status."""
    counts = entries.select(F.col("source").alias(key), F.col("verdict").alias("_verdict"), F.size("entries").alias("_n"), F.size(F.filter("entries", lambda e: e["basis"] == "inferred")).alias("_inferred"))
    updated = with_verdicts(ledger, judged, key, now).join(judged.select(F.col("key").alias(key), "ok"), key, "left").join(counts, key, "left")
    hit = F.coalesce("ok", F.lit(False))
    return updated.withColumns(
        {
            "verdict": F.when(hit, F.col("_verdict")).otherwise(F.col("verdict")),
            "n_entries": F.when(hit, F.greatest("_n", F.lit(0)).cast("string")).otherwise(F.col("n_entries")),
            "n_inferred": F.when(hit, F.greatest("_inferred", F.lit(0)).cast("string")).otherwise(F.col("n_inferred")),
            "status": F.when(hit & (F.col("_verdict") == "needs_human"), "needs_human").otherwise(F.col("status")),
        }
    ).select(*ledger.columns)


def reconciled(ledger: DataFrame, inventory: DataFrame, key: str, watched: Sequence[str]) -> DataFrame:
    """After a second inventory: new rows are pending, changed ones too, vanished ones removed_at_source.

    Adds ``change`` (added, changed, removed or same).
    """
    old, new = ledger.withColumn("_old", F.lit(True)).alias("old"), inventory.withColumn("_new", F.lit(True)).alias("new")
    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    moved = F.lit(False)
    for f in watched:
        moved |= text_of(F.col(f"old.{f}")) != text_of(F.col(f"new.{f}"))
    change = F.when(F.col("old._old").isNull(), "added").when(F.col("new._new").isNull(), "removed").when(moved, "changed").otherwise("same")
    given = set(inventory.columns)
    defaults = {"status": F.lit("pending"), "attempts": F.lit("0")}

    def value(f: str) -> Column:
        kept = F.coalesce(F.col(f"new.{f}").cast("string"), F.col(f"old.{f}")) if f in given and f not in REQUIRED else F.col(f"old.{f}")
        if f == "status":
            return F.when(change.isin("added", "changed"), "pending").when(change == "removed", "removed_at_source").otherwise(kept)
        if f == "attempts":
            return F.when(change == "added", "0").otherwise(kept)
        return F.when(change == "added", F.coalesce(F.col(f"new.{f}").cast("string"), F.lit("")) if f in given else defaults.get(f, F.lit(""))).otherwise(kept)

    return joined.select(F.coalesce(F.col(f"old.{key}"), F.col(f"new.{key}")).alias(key), *(value(f).alias(f) for f in ledger.columns if f != key), change.alias("change"))


def refreshed_counts(ledger: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """Overwrite the count fields of known keys and insert unknown keys as pending."""
    return merged(ledger, counts.select(key, *(F.col(c).cast("string").alias(c) for c in counts.columns if c != key)), key, update=True).drop("merge")


# ---- reports ----


def status_counts(ledger: DataFrame) -> DataFrame:
    """(status, n) with ``(total)`` and ``(still open)``."""
    status = F.when(text_of(F.col("status")) == "", "(blank)").otherwise(F.col("status"))
    counts = ledger.select(status.alias("status")).rollup("status").agg(F.count("*").alias("n"), F.count_if(F.col("status").isin(list(OPEN))).alias("open"))
    named = counts.select(F.coalesce("status", F.lit("(total)")).alias("status"), "n")
    still = ledger.agg(F.count_if(F.col("status").isin(list(OPEN))).alias("n")).select(F.lit("(still open)").alias("status"), "n")
    return named.unionByName(still)


def ledger_diff(ledger: DataFrame, other: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(key, change, field, old, new): keys in one ledger only, and each changed field; an absent field counts as empty."""
    side = lambda df, name: df.select(F.col(key).cast("string").alias("key"), F.lit(True).alias(name), *((text_of(F.col(f)) if f in df.columns else F.lit("")).alias(f"{name}_{f}") for f in fields))
    joined = side(ledger, "a").join(side(other, "b"), "key", "full_outer")
    none = F.lit(None).cast("string")
    lone = F.when(F.col("b").isNull(), "only_first").when(F.col("a").isNull(), "only_second")
    pairs = F.array(*(F.struct(F.lit("changed").alias("change"), F.lit(f).alias("field"), F.col(f"a_{f}").alias("old"), F.col(f"b_{f}").alias("new")) for f in fields))
    rows = F.when(lone.isNotNull(), F.array(F.struct(lone.alias("change"), none.alias("field"), none.alias("old"), none.alias("new")))).otherwise(F.filter(pairs, lambda p: p["old"] != p["new"]))
    return joined.select("key", F.explode(rows).alias("r")).select("key", "r.*")


def key_sets(ledger: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """(key, side): first, second or both."""
    a, b = ledger.select(F.col(key).alias("key")).distinct().withColumn("a", F.lit(1)), other.select(F.col(key).alias("key")).distinct().withColumn("b", F.lit(1))
    return a.join(b, "key", "full_outer").select("key", F.when(F.col("b").isNull(), "first").when(F.col("a").isNull(), "second").otherwise("both").alias("side"))


def acceptance(ledger: DataFrame, checks: DataFrame | None = None, terminal: Sequence[str] = ("verified",), noted: Sequence[str] = (), outputs_missing: Sequence[str] = ()) -> DataFrame:
    """One row (accepted, open_rows, failing_checks, unnoted, missing): open rows are those of no terminal status.

    ``noted`` statuses are terminal if the row has a note.
    """
    is_noted = F.col("status").isin(list(noted)) if noted else F.lit(False)
    blank = text_of(F.col("notes")) == ""
    rows = ledger.agg(F.count_if(~F.col("status").isin(list(terminal)) & ~is_noted).alias("open_rows"), F.count_if(is_noted & blank).alias("unnoted"))
    bad = checks.agg(F.count_if(~F.col("ok")).alias("failing_checks")) if checks is not None else ledger.sparkSession.createDataFrame([(0,)], "failing_checks long")
    both = rows.crossJoin(F.broadcast(bad)).withColumn("missing", F.lit(", ".join(outputs_missing)))  # one row each
    return both.select(((F.col("open_rows") == 0) & (F.col("unnoted") == 0) & (F.col("failing_checks") == 0) & (F.col("missing") == "")).alias("accepted"), "open_rows", "failing_checks", "unnoted", "missing")


def numeric_key_order(key: Column) -> list[Column]:
    """Sort columns of ticket keys: project, then the number as a number."""
    return [F.substring_index(key, "-", 1), F.substring_index(key, "-", -1).try_cast("bigint")]


def top_values(rows: DataFrame, value: str, n: int) -> DataFrame:
    """(value, n) of the n most common values; ties by value."""
    return rows.groupBy(value).agg(F.count("*").alias("n")).orderBy(F.desc("n"), value).limit(n)


def ordered_within(rows: DataFrame, group: Sequence[str], order: Sequence) -> DataFrame:
    """Add ``place``, 1 for the first row of each group."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def numbered(rows: DataFrame, order: Sequence[Column], name: str = "place") -> DataFrame:
    """Add ``name``: the place of each row in the order of all rows, from 1.

    Rows are cut into ranges of the order, numbered inside each range, and moved on by the counts of the ranges before it,
    so no task sees all rows.  Rows that are equal in the order are numbered in any order.
    """
    ranged = checkpointed(rows.withColumns({f"_o{k}": c for k, c in enumerate(order)}).repartitionByRange(*(F.col(f"_o{k}") for k in range(len(order)))).withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))  # one row for each range
    before = counts.select("_range", (F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*(f"_o{k}" for k in range(len(order)))))
    return ranged.withColumn("_inside", inside).join(F.broadcast(before), "_range").select(*rows.columns, (F.col("_before") + F.col("_inside")).alias(name))
