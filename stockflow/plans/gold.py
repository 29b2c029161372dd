"""Daily gold tables: G1, G2, G3."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow import schemas
from stockflow.functions import vocabulary as V
from stockflow.lake import Lake
from stockflow.operators.latest import latest_state
from stockflow.operators.movement import net_movement
from stockflow.sinks.partitions import overwrite_partitions
from stockflow.sources.config import read_snapshots
from stockflow.sources.tables import read_state_history, read_valid_movements

# Reconciliation outcomes.
NO_STREAMING_STATE = "NO_STREAMING_STATE"
MATCH = "MATCH"
MISMATCH = "MISMATCH"


def _zero(name: str):
    return F.coalesce(name, F.lit(0)).cast("bigint")


def _openings(snapshots: DataFrame) -> DataFrame:
    return snapshots.select(
        F.col("snapshot_date").alias("business_date"),
        *V.STOCK_KEY,
        "product_name",
        F.col("opening_sellable_stock").cast("bigint").alias("opening_sellable_stock"),
    )


def reconciliation(
    snapshots: DataFrame, movement: DataFrame, state: DataFrame
) -> DataFrame:
    """Stock recomputed from the opening against the streamed stock.

    All three inputs have one row per business day and stock key, so the joins
    have no hot key. Keys outside the snapshot drop out.
    """
    keys = ["business_date", *V.STOCK_KEY]
    joined = (
        _openings(snapshots)
        .join(
            movement.select(*keys, "net_movement_qty", "event_count"), keys, "left"
        )
        .join(state.select(*keys, "streaming_sellable_stock"), keys, "left")
    )
    unseen = F.col("streaming_sellable_stock").isNull()
    recomputed = F.col("opening_sellable_stock") + _zero("net_movement_qty")
    streamed = F.coalesce("streaming_sellable_stock", "opening_sellable_stock")
    difference = recomputed - streamed
    return joined.select(
        F.col("business_date").alias("recon_date"),
        *V.STOCK_KEY,
        "opening_sellable_stock",
        _zero("net_movement_qty").alias("net_movement_qty"),
        recomputed.alias("batch_recomputed_sellable_stock"),
        streamed.cast("bigint").alias("streaming_sellable_stock"),
        difference.alias("diff_qty"),
        F.when((_zero("event_count") > 0) & unseen, F.lit(NO_STREAMING_STATE))
        .when(difference == 0, F.lit(MATCH))
        .otherwise(F.lit(MISMATCH))
        .alias("status"),
    )


def daily_summary(snapshots: DataFrame, movement: DataFrame) -> DataFrame:
    """The day's totals per key, zero where nothing moved."""
    keys = ["business_date", *V.STOCK_KEY]
    totals = [_zero(name).alias(f"total_{name}") for name in V.QUANTITY_TOTALS]
    closing = (
        F.col("opening_sellable_stock")
        + _zero("replenished_qty")
        + _zero("sales_movement_qty")
    )
    return (
        _openings(snapshots)
        .join(movement, keys, "left")
        .select(
            F.col("business_date").alias("summary_date"),
            *V.STOCK_KEY,
            "product_name",
            "opening_sellable_stock",
            *totals,
            _zero("sales_movement_qty").alias("sales_movement_qty"),
            _zero("net_movement_qty").alias("net_movement_qty"),
            closing.alias("closing_sellable_stock"),
            _zero("event_count").alias("event_count"),
        )
    )


def write_gold(
    lake: Lake, snapshots: DataFrame, movements: DataFrame, history: DataFrame
) -> None:
    """Both gold tables of the days and campaigns in the snapshots.

    Any number of days is the same two joins over more partitions, not a loop over
    days. The net movement feeds both tables and is computed once.
    """
    movement = net_movement(movements).persist()
    now = F.current_timestamp()
    try:
        overwrite_partitions(
            reconciliation(snapshots, movement, latest_state(history))
            .withColumn("created_at", now)
            .select(*schemas.column_names(schemas.GOLD_RECONCILIATION)),
            lake.gold_reconciliation,
            ["recon_date", "campaign_id"],
        )
        overwrite_partitions(
            daily_summary(snapshots, movement)
            .withColumn("created_at", now)
            .select(*schemas.column_names(schemas.GOLD_DAILY_SUMMARY)),
            lake.gold_daily_summary,
            ["summary_date", "campaign_id"],
        )
    finally:
        movement.unpersist()


def run_gold(
    spark: SparkSession,
    lake: Lake,
    date: str | None = None,
    campaign_id: str | None = None,
) -> None:
    """Gold for one day and campaign, or for all that the lake holds."""
    write_gold(
        lake,
        read_snapshots(spark, lake.snapshots, date, campaign_id),
        read_valid_movements(spark, lake, date, campaign_id),
        read_state_history(spark, lake, date, campaign_id),
    )
