"""Lake tables read by the batch jobs: S4, S5, S8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow import schemas
from stockflow.lake import Lake
from stockflow.operators.dedupe import keep_first
from stockflow.sinks.snapshots import SnapshotTable
from stockflow.storage import read_table


def of_slice(
    rows: DataFrame, date_column: str, date: str | None, campaign_id: str | None
) -> DataFrame:
    """one business day and one campaign, each only if given.

    The day is a DATE literal, so the filter prunes partitions.
    """
    if date is not None:
        rows = rows.filter(F.col(date_column) == F.to_date(F.lit(date)))
    if campaign_id is not None:
        rows = rows.filter(F.col("campaign_id") == campaign_id)
    return rows


def valid_movements(
    movements: DataFrame, date: str | None = None, campaign_id: str | None = None
) -> DataFrame:
    """Valid movements, first arrival per event, day and campaign."""
    rows = of_slice(movements, "business_date", date, campaign_id)
    return keep_first(
        rows.filter("is_valid_event"), ["business_date", "campaign_id", "event_id"]
    )


def read_valid_movements(
    spark: SparkSession,
    lake: Lake,
    date: str | None = None,
    campaign_id: str | None = None,
) -> DataFrame:
    """Valid, de-duplicated movements of the silver table."""
    movements = read_table(spark, lake.silver_movements, schemas.SILVER_MOVEMENTS)
    return valid_movements(movements, date, campaign_id)


def last_finished(spark: SparkSession, lake: Lake) -> int | None:
    """The newest batch of the state stream whose outputs are complete, if any."""
    marks = read_table(spark, lake.finished_batches, "id BIGINT")
    return marks.agg(F.max("id")).first()[0]


def finished(spark: SparkSession, lake: Lake, rows: DataFrame) -> DataFrame:
    """Rows of finished batches; all rows of a lake that no stream has written."""
    last = last_finished(spark, lake)
    return rows if last is None else rows.filter(F.col("batch_id") <= last)


def read_alerts(spark: SparkSession, lake: Lake) -> DataFrame:
    """Alerts of finished batches."""
    return finished(spark, lake, read_table(spark, lake.alerts, schemas.ALERTS))


def packed_history(spark: SparkSession, lake: Lake) -> SnapshotTable:
    """The part of the state history that has been packed."""
    keys = ["business_date", "campaign_id"]
    return SnapshotTable(
        spark, lake.packed_history, schemas.STATE_HISTORY, keys, ["sku_id", "warehouse_id"]
    )


def read_state_history(
    spark: SparkSession,
    lake: Lake,
    date: str | None = None,
    campaign_id: str | None = None,
) -> DataFrame:
    """State history of a day. A day without history has no rows.

    What one version of the packed table holds, and of later batches their folders.
    """
    table = packed_history(spark, lake)
    version = table.version()

    def sliced(rows: DataFrame) -> DataFrame:
        return of_slice(rows, "business_date", date, campaign_id)

    history = read_table(spark, lake.state_history, schemas.STATE_HISTORY)
    history = sliced(finished(spark, lake, history))
    if not version:
        return history
    loose = history.filter(F.col("batch_id") >= table.upto(version))
    return table.read(version, sliced).unionByName(loose)


def read_gold(
    spark: SparkSession,
    path: str,
    schema: str,
    date_column: str,
    date: str | None = None,
    campaign_id: str | None = None,
) -> DataFrame:
    """A gold slice; day and campaign come back from the partition path."""
    return of_slice(
        read_table(spark, path, schema), date_column, date, campaign_id
    )
