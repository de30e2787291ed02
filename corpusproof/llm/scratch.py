"""Where intermediate tables live, and how lineage is cut.

Intermediate results go to the folder that the session names in ``spark.checkpoint.dir``, which every executor of a
cluster shares.  Only where that setting is absent and the master is ``local`` (tests, a laptop) a folder under ``/tmp``
takes its place; on a cluster its absence is an error.

Intermediate tables stay until the session's work is read from them.  A caller that has stored its result can have
those made on the way removed: ``with removed(spark): written(...)``.
"""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders made inside each open block of ``removed``, by thread.
_made = threading.local()

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder's URI; also makes it Spark's checkpoint folder where none is set."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.conf.get("corpusproof.local.dir", None)
        if not named:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            named = "file://" + tempfile.mkdtemp(prefix="corpusproof-", dir="/tmp")
            spark.conf.set("corpusproof.local.dir", named)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder."""
    path = f"{shared_dir(spark)}/corpusproof/{name}-{uuid.uuid4().hex[:12]}"
    for made in getattr(_made, "open", ()):
        made.append(path)
    return path


@contextmanager
def removed(spark: SparkSession, but: tuple[str, ...] = ()) -> Iterator[None]:
    """Remove the folders that this thread makes inside the block, at its end, but for those whose names begin with one of ``but``."""
    made: list[str] = []
    _made.open = [*getattr(_made, "open", ()), made]
    try:
        yield
    finally:
        _made.open = [m for m in _made.open if m is not made]
        for path in made:
            if not path.rsplit("/", 1)[1].startswith(but):
                _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def forget(df: DataFrame) -> None:
    """Remove the table behind ``df``, which ``written`` has made and from which nothing is read any more."""
    _delete(df.sparkSession, df._scratch_path)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, computed once, stored as Parquet in the shared folder and read again.

    Shuffle files of the write go as soon as it ends: nothing reads them again.
    """
    spark = df.sparkSession
    path = new_dir(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._scratch_path = path
    return stored
