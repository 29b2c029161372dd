"""A keyed table that a stream updates batch by batch: K5, D4."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockflow.sinks.leveled import BUCKETS, FANOUT, LeveledRuns
from stockflow.storage import exists


class KeyedLog:
    """Seeded rows and the rows each batch changed, in buckets by key.

    A batch writes only the keys it changed and reads only the buckets of the keys it
    meets, so its cost follows the batch and not the table. A replayed batch replaces
    its own output and never reads it.

    Rows carry a version: odd for the changes of a batch, even for rows seeded between
    two batches. The highest version of a key counts, and of equal ones the last updated.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: str,
        keys: list[str],
        fanout: int = FANOUT,
        buckets: int = BUCKETS,
    ):
        self.spark = spark
        self.keys = keys
        self.versions = f"{schema}, _version BIGINT"
        self.runs = LeveledRuns(
            spark, f"{root}/runs", self.versions, keys, self._newest, fanout, buckets
        )
        self.seeds = f"{root}/seeds"

    def seed(self, rows: DataFrame, before_batch: int = 0) -> None:
        """Insert or replace rows by key, in effect from a batch that is to come."""
        versioned = _versioned(rows, 2 * before_batch)
        (
            versioned.withColumn("bucket", self.runs.bucket())
            .hint("rebalance", F.col("bucket"))
            .sortWithinPartitions("bucket", *self.keys)
            .write.mode("append")
            .partitionBy("bucket")
            .parquet(self.seeds)
        )

    def write(self, changes: DataFrame, batch_id: int) -> None:
        """Store the rows a batch changed. Every batch calls this, also for none."""
        self.runs.write(_versioned(changes, 2 * batch_id + 1), batch_id)

    def finish(self, batch_id: int) -> None:
        """Merge the runs that a batch completes."""
        self.runs.finish(batch_id)

    def forget(self, batch_id: int) -> None:
        """Drop runs that no reader of the batch or the one before it needs."""
        self.runs.forget(batch_id)

    def _newest(self, versions: DataFrame) -> DataFrame:
        newest = Window.partitionBy(*self.keys).orderBy(
            F.desc("_version"), F.desc("updated_at")
        )
        ranked = versions.withColumn("_rank", F.row_number().over(newest))
        return ranked.filter(F.col("_rank") == 1).drop("_rank")

    def _rows(self, end: int, only: DataFrame | None) -> DataFrame:
        """Rows as they stand before batch ``end``."""
        buckets = None if only is None else self.runs.touched(only)
        versions = self.runs.read(end, buckets)
        if exists(self.spark, self.seeds):
            seeds = self.spark.read.schema(f"{self.versions}, bucket INT").parquet(self.seeds)
            seeds = seeds.filter(F.col("_version") <= 2 * end)
            if buckets is not None:
                seeds = seeds.filter(F.col("bucket").isin(buckets))
            versions = versions.unionByName(seeds.drop("bucket"))
        if only is not None:
            versions = versions.join(only, self.keys, "left_semi")
        return self._newest(versions).drop("_version")

    def before(self, batch_id: int, only: DataFrame | None = None) -> DataFrame:
        """Rows as they stand when the batch begins.

        ``only`` restricts them to the keys it holds, before versions are compared.
        """
        return self._rows(batch_id, only)

    def after(self, batch_id: int) -> DataFrame:
        """Rows as they stand when the batch has been applied."""
        return self._rows(batch_id + 1, None)


def _versioned(rows: DataFrame, version: int) -> DataFrame:
    return rows.withColumn("_version", F.lit(version).cast("bigint"))
