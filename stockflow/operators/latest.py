"""Latest state per stock key: W1."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.functions import vocabulary as V


def latest_state(history: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The last processed history row per business day and stock key.

    Rows of one batch share their processing time, so arrival order decides among
    them before the event's own columns. The ``row_number() = 1`` filter becomes a
    group limit before the exchange, as in ``keep_first``.
    """
    keys = by or ["business_date", *V.STOCK_KEY]
    last_first = [
        F.col(name).desc()
        for name in [
            "processed_at", *V.ARRIVAL, "business_date", "event_time", "event_id"
        ]
    ]
    return (
        history.withColumn(
            "_rank",
            F.row_number().over(Window.partitionBy(*keys).orderBy(*last_first)),
        )
        .filter(F.col("_rank") == 1)
        .select(
            *keys,
            F.col("current_sellable_stock").alias("streaming_sellable_stock"),
            F.col("status").alias("streaming_status"),
            F.col("event_id").alias("last_event_id"),
            F.col("event_time").alias("last_event_time"),
            F.col("processed_at").alias("updated_at"),
        )
    )
