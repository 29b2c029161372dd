"""What running streams report of themselves: T11, T10."""

from __future__ import annotations

import json
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

SCHEMA = (
    "query STRING, batch_id BIGINT, input_rows BIGINT, rows_per_second DOUBLE, "
    "state_rows BIGINT, state_bytes BIGINT, rows_dropped_late BIGINT"
)


class Progress(StreamingQueryListener):
    """Collects every batch of every stream: rows, speed, state, rows dropped as late.

    One small record per batch stays on the driver, up to ``most`` of them; ``write``
    moves them to a table.
    """

    def __init__(self, most: int = 100_000):
        self.most = most
        self._records: list[tuple] = []
        self._lock = Lock()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        record = progress_record(json.loads(event.progress.json))
        with self._lock:
            self._records = [*self._records[1 - self.most :], record]

    def records(self) -> list[tuple]:
        with self._lock:
            return list(self._records)

    def rows(self, spark: SparkSession) -> DataFrame:
        """One row per query and batch."""
        return spark.createDataFrame(self.records(), SCHEMA)

    def write(self, spark: SparkSession, path: str) -> None:
        """Append what has been collected to a table and forget it."""
        with self._lock:
            records, self._records = self._records, []
        if records:
            spark.createDataFrame(records, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def progress_record(progress: dict) -> tuple:
    """The figures of one progress report, state operators added up."""
    states = progress.get("stateOperators", [])

    def total(name: str) -> int:
        return sum(int(state.get(name, 0)) for state in states)

    return (
        progress.get("name") or progress["id"],
        int(progress["batchId"]),
        int(progress["numInputRows"]),
        float(progress.get("processedRowsPerSecond", 0.0)),
        total("numRowsTotal"),
        total("memoryUsedBytes"),
        total("numRowsDroppedByWatermark"),
    )
