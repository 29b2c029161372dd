"""Effects of a set of events on stock and promotions: T3, T5, T6, T7.

Pure functions of DataFrames. The batch twin and the micro-batch sink call the
same ones, so the two cannot drift apart.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow import schemas
from stockflow.functions import keys as K
from stockflow.functions import status as S
from stockflow.functions import vocabulary as V
from stockflow.operators import dedupe
from stockflow.operators.promotion import (
    apply_promotion_counters,
    counts_for_promotion,
)
from stockflow.operators.running import BLOCK_OFFSETS, running_levels


class Effects(NamedTuple):
    """What a set of accepted events does."""

    ledger: DataFrame
    history: DataFrame
    alerts: DataFrame
    changed_inventory: DataFrame
    changed_promotions: DataFrame


def accepted_columns(events: DataFrame, processed_at: Column) -> DataFrame:
    """The columns the state needs, stamped once with the processing time."""
    stamped = events.withColumn("processed_at", processed_at)
    return stamped.select(*schemas.column_names(schemas.ACCEPTED))


def processed_events(accepted: DataFrame) -> DataFrame:
    """the register of consumed event ids."""
    return accepted.filter(dedupe.has_event_id()).select(
        "event_id",
        "campaign_id",
        F.col("event_timestamp").alias("event_time"),
        "event_type",
        "sku_id",
        "warehouse_id",
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "processed_at",
    )


def stock_ledger(
    valid: DataFrame, inventory: DataFrame, block_offsets: int = BLOCK_OFFSETS
) -> DataFrame:
    """Stock before and after every valid event, in arrival order.

    Events whose key has no inventory row keep NULL levels.
    """
    openings = inventory.select(
        *V.STOCK_KEY,
        F.coalesce("current_sellable_stock", F.lit(0)).alias("_opening"),
        F.col("low_stock_threshold").alias("_threshold"),
    )
    moved = valid.withColumn("movement_qty", F.coalesce("movement_qty", F.lit(0)))
    current = F.col("_opening") + F.col("_carry") + F.col("_within")
    return (
        running_levels(moved, openings, V.STOCK_KEY, "movement_qty", block_offsets)
        .withColumn("current_sellable_stock", current)
        .withColumn(
            "previous_sellable_stock",
            F.col("current_sellable_stock") - F.col("movement_qty"),
        )
        .withColumn(
            "status",
            F.when(
                F.col("_opening").isNotNull(),
                S.inventory_status(
                    F.col("current_sellable_stock"), F.col("_threshold")
                ),
            ).otherwise(F.lit(S.UNKNOWN_SKU)),
        )
        .drop("_opening", "_threshold", "_carry", "_within")
    )


def state_history(ledger: DataFrame) -> DataFrame:
    """One history row per event that moved a known stock key."""
    return ledger.filter(F.col("status") != S.UNKNOWN_SKU).select(
        K.deterministic_id(F.lit("history"), F.col("event_id")).alias("history_id"),
        K.inventory_key().alias("inventory_key"),
        "event_id",
        "campaign_id",
        "sku_id",
        "warehouse_id",
        F.col("event_timestamp").alias("event_time"),
        "business_timestamp",
        "business_date",
        "event_type",
        F.coalesce("quantity", F.lit(0)).alias("quantity"),
        "movement_qty",
        "previous_sellable_stock",
        "current_sellable_stock",
        "status",
        "processed_at",
        *V.ARRIVAL,
    )


def _alert_rows(
    rows: DataFrame, alert_type: Column, message: Column, stock: Column
) -> DataFrame:
    position = F.concat_ws("/", "kafka_topic", *V.ARRIVAL)
    return (
        rows.withColumn("alert_type", alert_type)
        .withColumn("current_sellable_stock", stock)
        .withColumn("message", message)
        .select(
            K.deterministic_id(position, F.col("alert_type")).alias("alert_id"),
            F.coalesce(
                F.nullif("campaign_id", F.lit("")), F.lit(S.UNKNOWN)
            ).alias("campaign_id"),
            "alert_type",
            "sku_id",
            "warehouse_id",
            "current_sellable_stock",
            "event_id",
            "message",
            *V.ARRIVAL,
            F.col("processed_at").alias("created_at"),
        )
    )


def alerts(
    accepted: DataFrame, ledger: DataFrame, promotions: DataFrame
) -> DataFrame:
    """Invalid events, stock alerts, and unknown promotions.

    Invalid events need a filter only and stock alerts come with the ledger. Just
    the promotional events, few columns wide, are looked up in the promotions.
    """
    no_stock = F.lit(None).cast("bigint")
    invalid = _alert_rows(
        accepted.filter(~dedupe.has_event_id() | ~F.col("is_valid_event")),
        F.lit(S.INVALID_EVENT),
        S.invalid_event_message(F.col("event_id"), F.col("invalid_reason")),
        no_stock,
    )
    level = F.col("current_sellable_stock")
    stock = _alert_rows(
        ledger.filter(F.col("status") != S.NORMAL),
        F.col("status"),
        F.coalesce(
            S.stock_message(F.col("status"), level), F.lit(S.UNKNOWN_SKU_MESSAGE)
        ),
        level,
    )
    unknown_promotion = _alert_rows(
        accepted.filter(dedupe.has_event_id() & counts_for_promotion()).join(
            promotions.select(*V.PROMOTION_KEY), V.PROMOTION_KEY, "left_anti"
        ),
        F.lit(S.UNKNOWN_PROMOTION),
        F.lit(S.UNKNOWN_PROMOTION_MESSAGE),
        no_stock,
    )
    return invalid.unionByName(stock).unionByName(unknown_promotion)


def changed_inventory(inventory: DataFrame, ledger: DataFrame) -> DataFrame:
    """Inventory rows touched by the ledger, at the level of the last event.

    The last event per key is a maximum, so it combines on the map side.
    """
    last = (
        ledger.filter(F.col("status") != S.UNKNOWN_SKU)
        .groupBy(*V.STOCK_KEY)
        .agg(
            F.max(
                F.struct(
                    *V.ARRIVAL,
                    "event_id",
                    "event_timestamp",
                    "current_sellable_stock",
                    "status",
                    "processed_at",
                )
            ).alias("_last")
        )
    )
    return (
        inventory.join(last, V.STOCK_KEY, "inner")
        .withColumns(
            {
                "current_sellable_stock": F.col("_last.current_sellable_stock"),
                "status": F.col("_last.status"),
                "last_event_id": F.col("_last.event_id"),
                "last_event_time": F.coalesce(
                    "_last.event_timestamp", "_last.processed_at"
                ),
                "updated_at": F.col("_last.processed_at"),
            }
        )
        .select(*inventory.columns)
    )


def changed_promotions(
    promotions: DataFrame, accepted: DataFrame, processed_at: Column
) -> DataFrame:
    """T5: promotion rows touched by the events, with their counters added."""
    return (
        apply_promotion_counters(promotions, accepted.filter(dedupe.has_event_id()))
        .withColumn("updated_at", processed_at)
        .select(*promotions.columns)
    )


def apply_events(
    accepted: DataFrame,
    inventory: DataFrame,
    promotions: DataFrame,
    processed_at: Column,
    block_offsets: int = BLOCK_OFFSETS,
) -> Effects:
    """All effects of accepted events, in the order the events prescribe.

    ``accepted`` holds the first delivery of each event, stored, because several
    outputs read it. Events without an id and invalid events only raise an alert;
    the others move stock, then count for their promotion even if the stock key is
    unknown.
    """
    valid = accepted.filter(dedupe.has_event_id() & F.col("is_valid_event"))
    ledger = stock_ledger(valid, inventory, block_offsets)
    return Effects(
        ledger,
        state_history(ledger),
        alerts(accepted, ledger, promotions),
        changed_inventory(inventory, ledger),
        changed_promotions(promotions, accepted, processed_at),
    )
