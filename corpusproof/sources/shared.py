"""Cutting lineage in iterative operators."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a ``local`` session without it uses one under /tmp."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("corpusproof.shared.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="corpusproof-", dir="/tmp")
        spark.conf.set("corpusproof.shared.dir", named)
    return named.rstrip("/")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder."""
    return f"{shared_folder(spark)}/corpusproof/{name}-{uuid.uuid4().hex[:12]}"


def checkpointed(df: DataFrame, by: str | None = None) -> DataFrame:
    """``df`` computed once and kept in the shared folder.

    With ``by``, its rows lie by that column and in its order, and Spark goes on knowing it: what is derived from the
    result is grouped and joined by it without another shuffle or sort.  (An adaptive plan does not tell how its rows lie.)
    """
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    if by is None:
        return df.checkpoint()
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df.repartition(by).sortWithinPartitions(by).checkpoint()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
