"""Mart load: K9, K10, K11, K12, A6, A7, G4."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow import schemas
from stockflow.lake import Lake
from stockflow.operators.merge import require_unique
from stockflow.sinks.snapshots import SnapshotTable
from stockflow.sources.tables import of_slice, read_gold

# Name of the load and longest error text in its log.
LOAD_NAME = "redshift_gold_load"
MAX_ERROR = 1000


@dataclass(frozen=True)
class Dataset:
    """One gold table and the staging and mart tables it is loaded into."""

    name: str
    date_column: str
    gold_schema: str
    fact_schema: str
    staging_table: str
    fact_table: str
    sort_columns: tuple[str, ...]

    @property
    def keys(self) -> list[str]:
        return [self.date_column, "campaign_id", "sku_id", "warehouse_id"]

    @property
    def partitions(self) -> list[str]:
        return [self.date_column, "campaign_id"]

    def gold_path(self, lake: Lake) -> str:
        return f"{lake.root.rstrip('/')}/gold/{self.name}"


# The two loads, in their order, with the mart's sort keys.
DAILY_SUMMARY = Dataset(
    "daily_inventory_summary",
    "summary_date",
    schemas.GOLD_DAILY_SUMMARY,
    schemas.FACT_DAILY_SUMMARY,
    "daily_inventory_summary_stg",
    "fact_daily_inventory_summary",
    ("summary_date", "campaign_id", "sku_id"),
)
RECONCILIATION = Dataset(
    "inventory_reconciliation",
    "recon_date",
    schemas.GOLD_RECONCILIATION,
    schemas.FACT_RECONCILIATION,
    "reconciliation_result_stg",
    "fact_reconciliation_result",
    ("recon_date", "campaign_id", "status"),
)
DATASETS = (DAILY_SUMMARY, RECONCILIATION)


def staging_table(spark: SparkSession, lake: Lake, dataset: Dataset) -> SnapshotTable:
    """The staging table of a dataset."""
    path = lake.staging(dataset.staging_table)
    return SnapshotTable(spark, path, dataset.gold_schema, dataset.partitions)


def fact_table(spark: SparkSession, lake: Lake, dataset: Dataset) -> SnapshotTable:
    """The mart table of a dataset."""
    path, order = lake.mart(dataset.fact_table), list(dataset.sort_columns)
    return SnapshotTable(spark, path, dataset.fact_schema, dataset.partitions, order)


def replace_staging(
    lake: Lake,
    dataset: Dataset,
    source: DataFrame,
    date: str | None = None,
    campaign_id: str | None = None,
) -> DataFrame:
    """K9: replace what the call covers by the source rows and return them.

    A day and campaign, all days of a campaign, all campaigns of a day, or everything:
    slices that the source no longer has are emptied. The new version holds it all, so no
    reader sees an empty slice that is about to be filled.
    """
    table = staging_table(source.sparkSession, lake, dataset)
    covered = F.lit(True)
    if date is not None:
        covered &= F.col(dataset.date_column) == F.to_date(F.lit(date))
    if campaign_id is not None:
        covered &= F.col("campaign_id") == campaign_id
    version = table.replace(source, covered)
    table.vacuum()
    return table.read(version, lambda listed: listed.filter(covered))


def success_log(
    lake: Lake, dataset: Dataset, listed: DataFrame, load_id: str, started_at: datetime
) -> DataFrame:
    """One log row per loaded day and campaign with its row count.

    The counts are those of the staged partitions, taken when they were written.
    """
    counts = listed.select(
        F.col(dataset.date_column).alias("business_date"),
        "campaign_id",
        F.col("n_rows").alias("rows_loaded"),
    )
    return _log_rows(
        lake, dataset, counts, load_id, started_at, "SUCCESS", F.lit(None)
    )


def failure_log(
    lake: Lake,
    dataset: Dataset,
    spark: SparkSession,
    date: str | None,
    campaign_id: str | None,
    load_id: str,
    started_at: datetime,
    error: str,
) -> DataFrame:
    """One log row for a failed load, with no rows and the error text."""
    nothing = spark.range(1).select(
        F.to_date(F.lit(date)).alias("business_date"),
        F.lit(campaign_id).cast("string").alias("campaign_id"),
        F.lit(0).cast("bigint").alias("rows_loaded"),
    )
    message = F.substring(F.lit(error), 1, MAX_ERROR)
    return _log_rows(lake, dataset, nothing, load_id, started_at, "FAILED", message)


def _log_rows(lake, dataset, counts, load_id, started_at, status, message):
    now = F.current_timestamp()
    return counts.select(
        F.lit(f"{load_id}_{dataset.name}").alias("load_id"),
        F.lit(LOAD_NAME).alias("pipeline_name"),
        F.lit(dataset.gold_path(lake)).alias("source_path"),
        F.lit(f"staging.{dataset.staging_table}").alias("target_staging_table"),
        F.lit(f"mart.{dataset.fact_table}").alias("target_mart_table"),
        "business_date",
        "campaign_id",
        F.lit(started_at).alias("load_started_at"),
        now.alias("load_finished_at"),
        "rows_loaded",
        F.lit(status).alias("status"),
        message.cast("string").alias("error_message"),
        now.alias("created_at"),
    ).select(*schemas.column_names(schemas.LOAD_LOG))


def load_dataset(
    spark: SparkSession,
    lake: Lake,
    dataset: Dataset,
    load_id: str,
    started_at: datetime,
    date: str | None = None,
    campaign_id: str | None = None,
) -> None:
    """S8, K9, A6, K10, K11 for one dataset."""
    source = read_gold(
        spark,
        dataset.gold_path(lake),
        dataset.gold_schema,
        dataset.date_column,
        date,
        campaign_id,
    )
    staged = replace_staging(lake, dataset, source, date, campaign_id)
    label = f"{dataset.staging_table}, date={date}, campaign_id={campaign_id}"
    require_unique(staged, dataset.keys, label)
    facts = fact_table(spark, lake, dataset)
    facts.merge(staged.withColumn("loaded_at", F.current_timestamp()), dataset.keys)
    facts.vacuum()
    listed = of_slice(
        staging_table(spark, lake, dataset).partitions(), dataset.date_column, date, campaign_id
    )
    success_log(lake, dataset, listed, load_id, started_at).write.mode("append").parquet(
        lake.load_log
    )


def load_mart(
    spark: SparkSession,
    lake: Lake,
    date: str | None = None,
    campaign_id: str | None = None,
    recon_date: str | None = None,
) -> str:
    """Load both datasets for a slice, or for everything in gold.

    The first failure is logged and raised again; later datasets are not loaded.
    Returns the load id.
    """
    started_at = datetime.now(timezone.utc)
    suffix = uuid.uuid4().hex[:8]
    load_id = f"{LOAD_NAME}_{date or 'all'}_{campaign_id or 'all'}_{suffix}"
    for dataset in DATASETS:
        day = date if dataset is DAILY_SUMMARY else (recon_date or date)
        try:
            load_dataset(
                spark, lake, dataset, load_id, started_at, day, campaign_id
            )
        except Exception as error:
            failure_log(
                lake, dataset, spark, day, campaign_id, load_id, started_at, str(error)
            ).write.mode("append").parquet(lake.load_log)
            raise
    return load_id
