"""Campaign seeding: B1, B2, B3."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow import schemas
from stockflow.functions import keys as K
from stockflow.functions import status as S
from stockflow.functions import vocabulary as V

logger = logging.getLogger(__name__)


def seed_inventory(initial: DataFrame) -> DataFrame:
    """B1: current inventory rows at their opening level."""
    stock = F.col("initial_sellable_stock").cast("bigint")
    threshold = F.col("low_stock_threshold").cast("bigint")
    now = F.current_timestamp()
    return initial.select(
        K.inventory_key().alias("inventory_key"),
        *V.STOCK_KEY,
        "product_name",
        stock.alias("initial_sellable_stock"),
        stock.alias("current_sellable_stock"),
        threshold.alias("low_stock_threshold"),
        S.inventory_status(stock, threshold).alias("status"),
        F.lit(None).cast("string").alias("last_event_id"),
        F.lit(None).cast("timestamp").alias("last_event_time"),
        now.alias("created_at"),
        now.alias("updated_at"),
    ).select(*schemas.column_names(schemas.CURRENT_INVENTORY))


def seed_promotions(config: DataFrame) -> DataFrame:
    """B2: promotion metric rows with both counters at zero."""
    now = F.current_timestamp()
    zero = F.lit(0).cast("bigint")
    return config.select(
        "*",
        K.promotion_key().alias("promotion_key"),
        zero.alias("promotion_consumed_qty"),
        zero.alias("promotion_cancelled_qty"),
        now.alias("created_at"),
        now.alias("updated_at"),
    ).withColumn(
        "promotion_quota", F.col("promotion_quota").cast("bigint")
    ).select(*schemas.column_names(schemas.PROMOTION_METRICS))


def opening_snapshot(initial: DataFrame, snapshot_date: str) -> DataFrame:
    """Snapshot rows of a day."""
    return initial.select(
        F.to_date(F.lit(snapshot_date)).alias("snapshot_date"),
        *V.STOCK_KEY,
        "product_name",
        F.col("initial_sellable_stock").alias("opening_sellable_stock"),
        "low_stock_threshold",
    )


def write_snapshots(snapshots: DataFrame, root: str) -> None:
    """Replace the snapshot of every day and campaign that occurs in the rows.

    The lines hold all columns; the folders' names repeat the day and campaign.
    """
    names = schemas.column_names(schemas.SNAPSHOT)
    rows = snapshots.select(
        F.to_csv(F.struct(*names)).alias("value"), "snapshot_date", "campaign_id"
    )
    slices = ["snapshot_date", "campaign_id"]
    (
        rows.hint("rebalance", *map(F.col, slices))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*slices)
        .text(root)
    )


def write_snapshot(
    initial: DataFrame, root: str, snapshot_date: str, campaign_id: str
) -> int:
    """Write the snapshot of one day and campaign, return its row count."""
    rows = opening_snapshot(initial, snapshot_date).filter(
        F.col("campaign_id") == campaign_id
    )
    count = rows.count()
    if not count:
        logger.warning("no opening snapshot rows for campaign %s", campaign_id)
        return 0
    write_snapshots(rows, root)
    return count
