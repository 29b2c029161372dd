"""Campaign configuration files: S3, S6, S7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow import schemas
from stockflow.storage import matches, partition_dir


def _csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def _of_campaign(rows: DataFrame, campaign_id: str | None) -> DataFrame:
    if campaign_id is None:
        return rows
    return rows.filter(F.col("campaign_id") == campaign_id)


def read_initial_inventory(
    spark: SparkSession, path: str, campaign_id: str | None = None
) -> DataFrame:
    """Opening stock per key, of one campaign or of all."""
    return _of_campaign(_csv(spark, path, schemas.INITIAL_INVENTORY), campaign_id)


def read_promotion_config(
    spark: SparkSession, path: str, campaign_id: str | None = None
) -> DataFrame:
    """Promotions with their windows as instants, and each row's place in the files."""
    rows = _csv(spark, path, schemas.PROMOTION_CONFIG).withColumn(
        "config_row",
        F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()),
    )
    rows = _of_campaign(rows, campaign_id)
    return rows.withColumns(
        {name: F.try_to_timestamp(name) for name in ["start_time", "end_time"]}
    )


def require_promotions(promotions: DataFrame, path: str) -> DataFrame:
    """S7 for the outgoing path, where a campaign without promotions is an error."""
    if promotions.isEmpty():
        raise ValueError(f"No promotion rows found in {path}")
    return promotions


def read_snapshots(
    spark: SparkSession,
    root: str,
    snapshot_date: str | None = None,
    campaign_id: str | None = None,
) -> DataFrame:
    """S3: opening snapshots below ``root``, by day and campaign if given.

    The files lie in a folder per day and campaign and hold both as columns. A given day
    or campaign chooses folders by their names, so nothing else is opened. Files may
    begin with a header line. Without such a folder there are no rows.
    """
    names = partition_dir(
        root,
        snapshot_date="*" if snapshot_date is None else snapshot_date,
        campaign_id="*" if campaign_id is None else campaign_id,
    ).replace("=%2A", "=*")
    if not matches(spark, names):
        return spark.createDataFrame([], schemas.SNAPSHOT)
    rows = spark.read.schema(schemas.SNAPSHOT).csv(names)
    header = F.col("snapshot_date").isNull() & (F.col("campaign_id") == "campaign_id")
    rows = rows.filter(~F.coalesce(header, F.lit(False)))
    if snapshot_date is not None:
        rows = rows.filter(F.col("snapshot_date") == F.to_date(F.lit(snapshot_date)))
    return _of_campaign(rows, campaign_id)
