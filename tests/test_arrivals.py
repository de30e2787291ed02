import pytest
from pyspark.sql import functions as F

from corpusproof.operators import ledger
from corpusproof.operators.bucketed import BucketedLedger
from corpusproof.streaming.arrivals import current, track_verdicts, updated, watch_bodies

SCHEMA = "page_id string, version string, html string"


def judge(batch):
    # an aggregation is allowed: every micro-batch is judged as a table
    return batch.groupBy(F.col("page_id").alias("key")).agg((F.max("html") != "bad").alias("ok")).select("key", "ok", F.lit("C").alias("failing"))


def test_late_repeated_and_restarted_batches(spark, tmp_path):
    home = str(tmp_path)
    parts = [
        [("1", "9", "bad"), ("2", "9", "good"), ("3", "9", "bad"), ("3", "8", "bad")],
        [("1", "9", "bad")],  # again: no second attempt, and no change
        [("1", "10", "good"), ("2", "7", "bad")],  # newer as a number; older, late
        [("3", "10", "bad"), ("3", "11", "bad"), ("4", "x", "good")],
    ]
    sizes = []
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{home}/bodies")
        changes = watch_bodies(spark, f"{home}/bodies", SCHEMA, home, judge)  # every call starts the streams anew
        sizes.append(changes.count())
    # one row for each key that a run has changed
    assert sizes == [3, 3, 5, 7]
    got = {r.key: (r.version, r.ok, r.attempts) for r in current(changes).collect()}
    assert got == {"1": ("10", True, 1), "2": ("9", True, 1), "3": ("11", False, 2), "4": ("x", True, 0)}
    start = spark.createDataFrame([(k, "pending", "1", "old") for k in ("1", "2", "3", "5")], "key string, status string, attempts string, notes string")
    assert {r.key: (r.status, r.attempts, r.notes) for r in updated(start, changes).collect()} == {"1": ("verified", "2", "old"), "2": ("verified", "2", "old"), "3": ("needs_human", "3", "old | C"), "5": ("pending", "1", "old")}


def test_verdicts_written_again_count_once(spark, tmp_path):
    home = str(tmp_path)
    rows = spark.createDataFrame([("1", "1", False, "C", 5)], "key string, version string, ok boolean, failing string, body long")
    for number in (0, 1):  # as when a batch is judged again after a failure
        rows.write.parquet(f"{home}/verdicts/batch={number}")
        track_verdicts(spark, f"{home}/verdicts", f"{home}/changes", f"{home}/state").awaitTermination()
    changes = spark.read.parquet(f"{home}/changes")
    assert [(r.key, r.attempts) for r in changes.collect()] == [("1", 1)]


@pytest.fixture()
def held(spark, tmp_path):
    rows = spark.range(2000).select(F.col("id").cast("string").alias("key"), F.lit("pending").alias("status"), F.lit("0").alias("attempts"), F.lit("").alias("notes"))
    made = BucketedLedger.create(rows, "held_ledger", str(tmp_path / "ledger"), "key", slices=16, buckets=4)
    yield made, rows
    made.drop()


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_updates_are_those_of_a_plain_ledger(spark, held):
    made, rows = held
    inventory = spark.createDataFrame([("7", "n7"), ("9999", "new")], "key string, notes string")
    checks = spark.createDataFrame([("7", True, ""), ("8", False, "C1")], "key string, ok boolean, failing string")
    now = F.lit("2024-05-06 07:08:00").cast("timestamp")
    slices = made.update(inventory, lambda part: ledger.merged(part, inventory, "key", update=True).drop("merge"))
    assert 1 <= len(slices) <= 2
    made.update(checks, lambda part: ledger.with_verdicts(part, checks, "key", now))
    want = ledger.with_verdicts(ledger.merged(rows, inventory, "key", update=True).drop("merge"), checks, "key", now)
    assert rows_of(made.rows()) == rows_of(want)
    assert made.update(checks.where("false"), lambda part: part.where("false")) == [] and made.rows().count() == 2001


def test_only_touched_slices_are_written_and_the_ledger_is_not_shuffled(spark, held, tmp_path):
    made, _ = held
    files = lambda: {str(p.relative_to(tmp_path)): p.stat().st_mtime_ns for p in (tmp_path / "ledger").rglob("*.parquet")}
    before = files()
    assert len(before) == 16  # each slice is one file of one bucket
    keys = spark.createDataFrame([("5",)], "key string")
    (touched,) = made.update(keys, lambda part: ledger.bulk_set(part, {"key": "5"}, {"status": "done"}))
    gone, new = before.keys() - files().keys(), files().keys() - before.keys()
    assert len(gone) == len(new) == 1 and all(f"slice={touched}/" in p for p in gone | new)
    assert made.rows().where("status = 'done'").count() == 1
    other = spark.range(100_000).select(F.col("id").cast("string").alias("key"), F.lit("x").alias("notes"))
    merged = ledger.merged(made.part([touched]), other.hint("merge"), "key", update=True)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "(slice#" in plan.split("PartitionFilters")[1][:60]
    assert plan.count("Exchange hashpartitioning") == 1  # of the inventory alone


def test_a_later_session_attaches_the_folder(spark, held, tmp_path):
    made, rows = held
    again = BucketedLedger.attach(spark, "held_again", str(tmp_path / "ledger"), "key", rows.columns, slices=16, buckets=4)
    try:
        keys = spark.createDataFrame([("5",)], "key string")
        again.update(keys, lambda part: ledger.bulk_set(part, {"key": "5"}, {"status": "done"}))
        assert again.rows().count() == 2000 and again.rows().where("status = 'done'").count() == 1
    finally:
        again.drop()
