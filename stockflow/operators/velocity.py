"""Five-minute sales velocity: A2, F3, T1, T2, P14."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.functions import events as E
from stockflow.functions import keys as K

# Window length and watermark, in business time.
WINDOW = "5 minutes"
WINDOW_MINUTES = 5
WATERMARK = "7 minutes"


def sales_velocity(events: DataFrame) -> DataFrame:
    """A2: orders and units sold per tumbling window, stock key and promotion.

    The filter comes before the watermark, so only sales advance it. On a batch
    DataFrame the watermark has no effect. A NULL promotion is a group of its own.
    """
    window = F.window("business_timestamp", WINDOW)
    return (
        events.filter(E.is_sale())
        .withWatermark("business_timestamp", WATERMARK)
        .groupBy(window, "campaign_id", "sku_id", "warehouse_id", "promotion_id")
        .agg(
            F.count("order_id").alias("order_count"),
            F.sum("quantity").alias("sold_qty"),
        )
        .select(
            "campaign_id",
            "sku_id",
            "warehouse_id",
            "promotion_id",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            F.lit(WINDOW_MINUTES).alias("window_size_minutes"),
            "order_count",
            "sold_qty",
            F.to_date("window.start").alias("window_date"),
            F.hour("window.start").alias("window_hour"),
        )
    )


def velocity_scope_rows(velocity: DataFrame) -> DataFrame:
    """Velocity rows keyed by scope and window start."""
    return velocity.select(
        K.velocity_scope().alias("velocity_scope"),
        "campaign_id",
        "sku_id",
        "warehouse_id",
        K.promotion_or_none().alias("promotion_id"),
        "window_start",
        "window_end",
        F.coalesce("window_size_minutes", F.lit(0))
        .cast("bigint")
        .alias("window_size_minutes"),
        F.coalesce("order_count", F.lit(0)).alias("order_count"),
        F.coalesce("sold_qty", F.lit(0)).alias("sold_qty"),
        "window_date",
        "window_hour",
    )
