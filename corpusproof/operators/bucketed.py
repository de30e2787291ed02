"""A ledger stored in hash buckets of its key, so that an update costs what it touches.

The table has a partition ``slice`` for each remainder of the key's hash and is bucketed by the key with the same hash: every
slice is one file of one bucket.  A join on the key reads the ledger by buckets, without an exchange, and an update reads
and writes only the slices that hold its keys, by dynamic partition overwrite.  The updates themselves are the functions of
``corpusproof.operators.ledger``, applied to the slices that are touched.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE = "slice"
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


class BucketedLedger:
    """A ledger of strings in ``folder``, known to the session as the table ``name``."""

    def __init__(self, spark: SparkSession, name: str, key: str):
        self.spark, self.name, self.key = spark, name, key

    @classmethod
    def create(cls, ledger: DataFrame, name: str, folder: str, key: str, slices: int = 64, buckets: int = 8) -> BucketedLedger:
        """Write ``ledger`` (one row for each key) into a new folder; ``slices`` must be a multiple of ``buckets``."""
        if slices % buckets:
            raise ValueError("slices must be a multiple of buckets")
        new = cls(ledger.sparkSession, name, key)
        sliced = ledger.withColumn(SLICE, F.pmod(F.hash(key), F.lit(slices)))
        # a slice lies in one bucket, so the rows of a task go to few files
        sliced.repartition(buckets, key).write.format("parquet").option("path", folder).partitionBy(SLICE).bucketBy(buckets, key).saveAsTable(name)
        new._keep("slices", slices)
        return new

    @classmethod
    def attach(cls, spark: SparkSession, name: str, folder: str, key: str, fields: Sequence[str], slices: int = 64, buckets: int = 8) -> BucketedLedger:
        """The ledger that an earlier session has created in ``folder``, with the same fields and numbers."""
        columns = ", ".join(f"`{f}` STRING" for f in fields)
        spark.sql(f"CREATE TABLE {name} ({columns}, {SLICE} INT) USING parquet OPTIONS (path '{folder}') PARTITIONED BY ({SLICE}) CLUSTERED BY ({key}) INTO {buckets} BUCKETS")
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        new = cls(spark, name, key)
        new._keep("slices", slices)
        return new

    def _keep(self, field: str, value: object) -> None:
        self.spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ('{field}' = '{value}')")

    @property
    def slices(self) -> int:
        return int(self.spark.sql(f"SHOW TBLPROPERTIES {self.name} ('slices')").first()["value"])

    def rows(self) -> DataFrame:
        """The ledger as it stands."""
        return self.spark.table(self.name).drop(SLICE)

    def touched(self, keys: DataFrame) -> list[int]:
        """The slices of the given keys: at most as many numbers as there are slices."""
        found = keys.select(F.pmod(F.hash(F.col(self.key).cast("string")), F.lit(self.slices)).alias(SLICE)).distinct()
        return sorted(r[0] for r in found.collect())

    def part(self, slices: Sequence[int]) -> DataFrame:
        """The rows of some slices, still bucketed by the key; other slices are not read."""
        return self.spark.table(self.name).where(F.col(SLICE).isin(list(slices))).drop(SLICE)

    def update(self, keys: DataFrame, change: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Replace the slices of ``keys`` by what ``change`` makes of their rows; returns their numbers.

        ``change`` gets the rows of those slices and may add rows with keys among ``keys``.  Null keys belong to no slice
        and are left out.  A slice is replaced as a whole once all are computed.  An update that fails half way can be
        repeated only if ``change`` gives the same for rows that it has changed already; for counts, keep what has been
        counted beside the ledger (see ``corpusproof.streaming.arrivals``).
        """
        slices = self.touched(keys.where(F.col(self.key).isNotNull()))
        if slices:
            columns = self.rows().columns
            new = change(self.part(slices)).select(*columns, F.pmod(F.hash(self.key), F.lit(self.slices)).alias(SLICE))
            before = self.spark.conf.get(_OVERWRITE)
            self.spark.conf.set(_OVERWRITE, "dynamic")  # the table's own setting would not let a query read what it replaces
            try:
                new.write.mode("overwrite").insertInto(self.name)
            finally:
                self.spark.conf.set(_OVERWRITE, before)
            self.spark.catalog.refreshTable(self.name)
        return slices

    def drop(self) -> None:
        """Forget the table; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
