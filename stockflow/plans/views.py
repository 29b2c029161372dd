"""Reporting views over the mart: V1-V4, A4, A5, W2, W3."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow import schemas
from stockflow.functions import vocabulary as V
from stockflow.lake import Lake
from stockflow.plans.mart import DAILY_SUMMARY, RECONCILIATION, fact_table
from stockflow.sinks.snapshots import SnapshotTable

# Columns of the dashboard views, in order.
INVENTORY_DASHBOARD = [
    "summary_date", "campaign_id", "sku_id", "warehouse_id", "product_name",
    "opening_sellable_stock", "total_reserved_qty", "total_cod_sold_qty",
    "total_cancelled_qty", "total_expired_qty", "total_returned_qty",
    "total_replenished_qty", "sales_movement_qty", "net_movement_qty",
    "closing_sellable_stock", "event_count", "created_at", "loaded_at",
]
RECONCILIATION_DASHBOARD = [
    "recon_date", "campaign_id", "sku_id", "warehouse_id",
    "opening_sellable_stock", "net_movement_qty",
    "batch_recomputed_sellable_stock", "streaming_sellable_stock", "diff_qty",
    "status", "created_at", "loaded_at",
]

# Monthly sums by output name.
MONTHLY_SUMS = {
    "total_reserved_qty": "total_reserved_qty",
    "total_cod_sold_qty": "total_cod_sold_qty",
    "total_cancelled_qty": "total_cancelled_qty",
    "total_expired_qty": "total_expired_qty",
    "total_returned_qty": "total_returned_qty",
    "total_replenished_qty": "total_replenished_qty",
    "total_sales_movement_qty": "sales_movement_qty",
    "total_net_movement_qty": "net_movement_qty",
    "total_event_count": "event_count",
}


def inventory_dashboard(facts: DataFrame) -> DataFrame:
    """V1."""
    return facts.select(*INVENTORY_DASHBOARD)


def reconciliation_dashboard(facts: DataFrame) -> DataFrame:
    """V2."""
    return facts.select(*RECONCILIATION_DASHBOARD)


def reconciliation_summary(facts: DataFrame) -> DataFrame:
    """V3/A4: keys and absolute difference per day, campaign and outcome."""
    return facts.groupBy("recon_date", "campaign_id", "status").agg(
        F.count("*").alias("sku_warehouse_count"),
        F.sum(F.abs(F.coalesce("diff_qty", F.lit(0)))).alias("total_abs_diff_qty"),
        F.max("loaded_at").alias("latest_loaded_at"),
    )


def monthly_summary(facts: DataFrame) -> DataFrame:
    """Monthly sums, the first opening and the latest closing.

    First and last rows are ordered by day, then load time. They are extremes, so
    everything combines on the map side in one aggregation without a sort.
    """
    group = ["month_date", *V.STOCK_KEY]
    when = F.struct("summary_date", "loaded_at")
    return (
        facts.withColumn("month_date", F.trunc("summary_date", "month"))
        .groupBy(*group)
        .agg(
            F.max_by("product_name", when).alias("product_name"),
            *[F.sum(name).alias(total) for total, name in MONTHLY_SUMS.items()],
            F.min_by("opening_sellable_stock", when).alias(
                "first_opening_sellable_stock"
            ),
            F.max_by("closing_sellable_stock", when).alias(
                "latest_closing_sellable_stock"
            ),
        )
    )


# View names.
VIEWS = (
    "vw_inventory_dashboard",
    "vw_reconciliation_dashboard",
    "vw_reconciliation_summary",
    "vw_monthly_campaign_sku_inventory_summary",
)


def monthly_table(spark: SparkSession, lake: Lake) -> SnapshotTable:
    """V4, stored."""
    path = lake.mart(VIEWS[3])
    return SnapshotTable(spark, path, schemas.MONTHLY_VIEW, ["month_date", "campaign_id"], ["sku_id"])


def reconciliation_table(spark: SparkSession, lake: Lake) -> SnapshotTable:
    """V3, stored."""
    path = lake.mart(VIEWS[2])
    return SnapshotTable(spark, path, schemas.RECONCILIATION_VIEW, ["recon_date", "campaign_id"])


def refresh_views(spark: SparkSession, lake: Lake) -> None:
    """A4/A5: bring the stored aggregates up to the newest mart.

    A view notes which version of its facts it reflects. Only groups of which a partition
    has changed since then are computed anew, from the partitions of those groups alone:
    a month of a campaign for V4, a day of a campaign for V3. If that version of the facts
    has been forgotten, everything counts as changed.
    """
    _refresh(
        fact_table(spark, lake, DAILY_SUMMARY), monthly_table(spark, lake),
        {"month_date": F.trunc("summary_date", "month"), "campaign_id": F.col("campaign_id")},
        monthly_summary,
    )
    _refresh(
        fact_table(spark, lake, RECONCILIATION), reconciliation_table(spark, lake),
        {"recon_date": F.col("recon_date"), "campaign_id": F.col("campaign_id")},
        reconciliation_summary,
    )


def _refresh(
    facts: SnapshotTable,
    view: SnapshotTable,
    groups: dict[str, Column],
    aggregate: Callable[[DataFrame], DataFrame],
) -> None:
    now, since = facts.version(), view.upto()
    if now == since:
        return
    changed = facts.changes(since if since in facts.versions() else 0, now)
    changed = changed.select(*[group.alias(f"_{name}") for name, group in groups.items()]).distinct()
    same = [group.eqNullSafe(F.col(f"_{name}")) for name, group in groups.items()]
    rows = facts.read(now, lambda listed: listed.join(changed, same, "left_semi"))
    view.replace(aggregate(rows), upto=now)
    view.vacuum()


def create_views(spark: SparkSession, lake: Lake) -> None:
    """Register the four views as temporary views over the mart tables."""
    summary = fact_table(spark, lake, DAILY_SUMMARY).read()
    recon = fact_table(spark, lake, RECONCILIATION).read()
    rows = (
        inventory_dashboard(summary),
        reconciliation_dashboard(recon),
        reconciliation_summary(recon),
        monthly_summary(summary),
    )
    for name, view in zip(VIEWS, rows, strict=True):
        view.createOrReplaceTempView(name)
