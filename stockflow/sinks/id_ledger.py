"""The deliveries a stream has consumed: F5, T4."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.operators.dedupe import delivery_key
from stockflow.sinks.leveled import BUCKETS, FANOUT, LeveledRuns
from stockflow.storage import drop, read_table

SCHEMA = "delivery STRING, seen TIMESTAMP"


class IdLedger:
    """Which deliveries the batches before have consumed, and when they were sent.

    A row is the delivery's key and its message time, whatever else the event holds. A
    batch opens the buckets of its own keys only.

    Without a ``horizon`` a key is remembered for good. With one, it is remembered while
    its message time is at most that much behind the newest message time of the batches
    before; what is older is left out of the next merge. A copy that comes later than that
    counts as a first delivery, and nothing is dropped for being late.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        horizon: timedelta | None = None,
        fanout: int = FANOUT,
        buckets: int = BUCKETS,
    ):
        self.spark = spark
        self.horizon = horizon
        self.marks = f"{root}/newest"
        self._merging = 0
        self.runs = LeveledRuns(
            spark, f"{root}/runs", SCHEMA, ["delivery"], self._remembered, fanout, buckets
        )

    def _newest(self, end: int) -> datetime | None:
        """The newest message time of the batches before ``end``."""
        if self.horizon is None or not end:
            return None
        row = read_table(self.spark, f"{self.marks}/batch={end - 1}", "seen TIMESTAMP").first()
        return row and row["seen"]

    def _remembered(self, rows: DataFrame) -> DataFrame:
        return self._within(rows, self._newest(self._merging))

    def _within(self, rows: DataFrame, newest: datetime | None) -> DataFrame:
        if newest is None:
            return rows
        young: Column = F.col("seen") >= F.lit(newest) - F.lit(self.horizon)
        return rows.filter(young | F.col("seen").isNull())

    def unseen(self, arrivals: DataFrame, batch_id: int) -> DataFrame:
        """Arrivals, one per delivery, that no batch before has consumed."""
        keyed = arrivals.withColumn("delivery", delivery_key())
        known = self.runs.read(batch_id, self.runs.touched(keyed))
        known = self._within(known, self._newest(batch_id))
        return keyed.join(known.select("delivery"), "delivery", "left_anti").drop("delivery")

    def write(self, accepted: DataFrame, batch_id: int) -> None:
        """Remember the stored first deliveries of a batch."""
        rows = accepted.select(delivery_key().alias("delivery"), F.col("kafka_timestamp").alias("seen"))
        self.runs.write(rows, batch_id)
        if self.horizon is not None:
            newest = rows.agg(F.greatest(F.max("seen"), F.lit(self._newest(batch_id))).alias("seen"))
            newest.write.mode("overwrite").parquet(f"{self.marks}/batch={batch_id}")

    def finish(self, batch_id: int) -> None:
        """Merge the runs that a batch completes, without what has expired."""
        self._merging = batch_id + 1
        self.runs.finish(batch_id)

    def forget(self, batch_id: int) -> None:
        """Drop runs that no reader of the batch or the one before it needs."""
        self.runs.forget(batch_id)
        drop(self.spark, f"{self.marks}/batch={batch_id - 3}")
