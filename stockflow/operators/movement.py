"""Net movement per stock key: A1."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.functions import vocabulary as V


def net_movement(movements: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A1: totals per stock key, by default per business day as well.

    All sums combine on the map side, so one hot key ships one row per map task.
    """
    quantity, moved = F.col("quantity").cast("bigint"), F.col("movement_qty")
    totals = [
        F.sum(
            F.when(F.col("event_type") == kind, quantity).otherwise(F.lit(0))
        ).alias(name)
        for name, kind in V.QUANTITY_TOTALS.items()
    ]
    sales = F.when(
        F.col("event_type") != "STOCK_REPLENISHED", moved.cast("bigint")
    ).otherwise(F.lit(0))
    return movements.groupBy(*(by or ["business_date", *V.STOCK_KEY])).agg(
        F.sum(moved).alias("net_movement_qty"),
        F.count("*").alias("event_count"),
        *totals,
        F.sum(sales).alias("sales_movement_qty"),
    )
