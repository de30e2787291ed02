"""Incremental checks of newly arrived page bodies: two streams, of which the second keeps what it knows of each key in the state store.

``judge_bodies`` checks each micro-batch of bodies and writes its verdicts.  ``track_verdicts`` holds for each key the
newest version, its verdict and the failed versions, and writes one row for each key that a micro-batch has changed and
none for others.  ``current`` is the last such row of each key, and ``updated`` a ledger with them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpusproof.operators.ledger import MOST_ATTEMPTS, appended_note

VERDICTS = "key string, version string, ok boolean, failing string, body long"
CHANGES = "key string, version string, ok boolean, failing string, attempts long"
_EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
_STATE = "newest long, version string, ok boolean, failing string, seen array<long>, bad array<long>"


def judge_bodies(spark: SparkSession, bodies: str, schema: str, verdicts: str, checkpoint: str, judge: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Check every body that arrives as Parquet in ``bodies`` and keep (key, version, ok, failing, body) of each in ``verdicts``.

    ``judge`` makes (key, ok, failing) of rows with one body of each page: the newest version of a page in a micro-batch,
    and of two bodies with that version the one with the smaller hash.  Versions are compared as numbers; one that is none
    is older than all.  Each micro-batch writes its own folder ``batch=N``, so one that runs again writes the same again.
    """

    def save(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("_body", F.xxhash64("html"))
        order = F.struct(_number("version"), -F.col("_body").cast("decimal(20)"))
        newest = rows.groupBy("page_id").agg(F.max_by(F.struct(*rows.columns), order).alias("r")).select("r.*")
        versions = newest.select(F.col("page_id").cast("string").alias("key"), F.col("version").cast("string").alias("version"), F.col("_body").alias("body"))
        judged = judge(newest.drop("_body")).select("key", "ok", "failing")
        judged.join(versions, "key").select("key", "version", "ok", "failing", "body").write.mode("overwrite").parquet(f"{verdicts}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(bodies)
    return stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _number(version: str):
    return F.coalesce(F.col(version).try_cast("bigint"), F.lit(-1))


def track_verdicts(spark: SparkSession, verdicts: str, changes: str, checkpoint: str, idle_days: int = 365) -> StreamingQuery:
    """Write the keys that new verdicts change to ``changes/batch=N``: (key, version, ok, failing, attempts).

    Attempts count each failed version once.  A version that is delivered again is no second attempt (its last verdict
    counts), and an older one that comes late changes only the count.  What is known of a key goes when nothing has come
    for ``idle_days``.  A micro-batch that runs again after a failure starts from the same state and writes the same.
    """

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changes}/batch={number}")

    def follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        newest, version, ok, failing, seen, bad = state.get if state.exists else (None, None, None, None, [], [])
        seen, bad = set(seen), set(bad)
        before = (newest, ok, failing, frozenset(bad))
        rows = pd.concat(list(frames))
        for r in rows.sort_values(["number", "batch", "body"]).itertuples():
            seen.add(r.number)
            bad = bad - {r.number} if r.ok else bad | {r.number}
            if newest is None or r.number >= newest:
                newest, version, ok, failing = r.number, r.version, bool(r.ok), r.failing
        state.update((int(newest), version, ok, failing, sorted(int(n) for n in seen), sorted(int(n) for n in bad)))
        state.setTimeoutDuration(idle_days * 86_400_000)
        if before != (newest, ok, failing, frozenset(bad)):
            yield pd.DataFrame({"key": [key[0]], "version": [version], "ok": [ok], "failing": [failing], "attempts": [len(bad)]})

    stream = spark.readStream.schema(f"{VERDICTS}, batch int").parquet(verdicts).withColumn("number", _number("version"))
    followed = stream.groupBy("key").applyInPandasWithState(follow, CHANGES, _STATE, "update", GroupStateTimeout.ProcessingTimeTimeout)
    # a timeout would ask for one more micro-batch for ever; what is idle goes with the next verdicts
    before = spark.conf.get(_EMPTY_BATCHES)
    spark.conf.set(_EMPTY_BATCHES, "false")
    try:
        return followed.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(_EMPTY_BATCHES, before)


def watch_bodies(spark: SparkSession, bodies: str, schema: str, home: str, judge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Judge and track all that has come since the last call; verdicts, changes and checkpoints lie in ``home``.

    Returns all changes so far (key, version, ok, failing, attempts, batch).
    """
    judge_bodies(spark, bodies, schema, f"{home}/verdicts", f"{home}/checkpoints/bodies", judge).awaitTermination()
    track_verdicts(spark, f"{home}/verdicts", f"{home}/changes", f"{home}/checkpoints/verdicts").awaitTermination()
    return spark.read.schema(f"{CHANGES}, batch int").parquet(f"{home}/changes")


def current(changes: DataFrame) -> DataFrame:
    """(key, version, ok, failing, attempts): the last change of each key."""
    last = changes.groupBy("key").agg(F.max_by(F.struct("version", "ok", "failing", "attempts"), "batch").alias("c"))
    return last.select("key", "c.*")


def updated(start: DataFrame, changes: DataFrame, most: int = MOST_ATTEMPTS) -> DataFrame:
    """The ledger ``start`` after ``changes``: passed keys are verified, failed ones have their attempts added and, from ``most`` on, need a human.

    It depends on ``start`` and the changes alone, so it is the same however often a batch is delivered.
    """
    seen = current(changes).select("key", F.col("ok").alias("_ok"), F.col("failing").alias("_failing"), F.col("attempts").alias("_tries"))
    joined = start.join(seen, "key", "left")
    tries = F.coalesce(F.col("attempts").try_cast("bigint"), F.lit(0)) + F.coalesce("_tries", F.lit(0))
    status = F.when(F.col("_ok"), "verified").when(tries >= most, "needs_human").when(F.col("_ok").isNotNull(), "failed").otherwise(F.col("status"))
    notes = F.when(~F.coalesce("_ok", F.lit(True)), appended_note(F.col("notes"), F.col("_failing"))).otherwise(F.col("notes"))
    return joined.withColumns({"status": status, "attempts": tries.cast("string"), "notes": notes}).select(*start.columns)
