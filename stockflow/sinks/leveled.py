"""Rows that numbered batches append, by hash bucket and merged by level: K5, F5."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.storage import children, drop

FANOUT = 8
BUCKETS = 64


class LeveledRuns:
    """Sorted runs of rows, one per batch, merged by level.

    A run of level k holds ``fanout`` ** k consecutive batches, so the first n batches
    are covered by fewer than ``fanout`` runs of each level, and every row is rewritten
    once per level. Batch numbers alone say which runs to read and when to merge, so a
    replayed batch writes the same runs in the same places and reads none of its own.

    Inside a run, rows lie in a folder per hash bucket of their key, sorted by it. A
    reader opens the buckets of the keys it looks for. The fan-out and the number of
    buckets are kept for the life of the table; the folder's name holds them.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: str,
        keys: list[str],
        reduce: Callable[[DataFrame], DataFrame] = lambda rows: rows,
        fanout: int = FANOUT,
        buckets: int = BUCKETS,
    ):
        if fanout < 2:
            raise ValueError("a run of the next level needs at least two runs")
        layout = children(spark, f"{root}/layout=*")
        if layout:
            fanout, buckets = map(int, layout[0].split("=")[1].split("x"))
        self.spark, self.schema, self.keys = spark, schema, keys
        self.reduce, self.fanout, self.buckets = reduce, fanout, buckets
        self.root = f"{root}/layout={fanout}x{buckets}"

    def bucket(self) -> Column:
        """The hash bucket of a row's key."""
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of some keys: as many numbers as there are buckets at most."""
        found = rows.select(self.bucket().alias("bucket")).distinct().collect()
        return sorted(row["bucket"] for row in found)

    def _path(self, level: int, number: int) -> str:
        return f"{self.root}/level={level}/run={number}"

    def cover(self, end: int) -> list[str]:
        """The runs that hold the batches before ``end``."""
        paths, level, number = [], 0, end
        while number:
            last = number % self.fanout
            paths += [self._path(level, at) for at in range(number - last, number)]
            level, number = level + 1, number // self.fanout
        return paths

    def read(self, end: int, buckets: list[int] | None = None) -> DataFrame:
        """Rows of the batches before ``end``, of some buckets or of all."""
        rows = self._rows(self.cover(end))
        if buckets is not None:
            rows = rows.filter(F.col("bucket").isin(buckets))
        return rows.drop("bucket")

    def _rows(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], f"{self.schema}, bucket INT")
        schema = f"{self.schema}, level INT, run BIGINT, bucket INT"
        rows = self.spark.read.option("basePath", self.root).schema(schema).parquet(*paths)
        return rows.drop("level", "run")

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Store what a batch adds. Every batch calls this, also for nothing."""
        self._store(rows.withColumn("bucket", self.bucket()), self._path(0, batch_id))

    def _store(self, rows: DataFrame, path: str) -> None:
        (
            rows.hint("rebalance", F.col("bucket"))
            .sortWithinPartitions("bucket", *self.keys)
            .write.mode("overwrite")
            .partitionBy("bucket")
            .parquet(path)
        )

    def _merges(self, end: int) -> list[tuple[list[str], str]]:
        """(sources, target) of the merges that are due after ``end`` batches."""
        found, level, size = [], 1, self.fanout
        while end and end % size == 0:
            number = end // size - 1
            first = number * self.fanout
            sources = [self._path(level - 1, first + at) for at in range(self.fanout)]
            found.append((sources, self._path(level, number)))
            level, size = level + 1, size * self.fanout
        return found

    def finish(self, batch_id: int) -> None:
        """Merge what a batch completes, before the batch counts as finished."""
        for sources, target in self._merges(batch_id + 1):
            self._store(self.reduce(self._rows(sources)), target)

    def forget(self, batch_id: int) -> None:
        """At the start of a batch, drop runs that were merged two batches ago.

        The batch itself and readers of the last finished one use the merged runs.
        """
        for sources, _ in self._merges(batch_id - 1):
            for path in sources:
                drop(self.spark, path)
