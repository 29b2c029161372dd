"""State history: one folder per batch, packed by day afterwards: K7, S5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow import schemas
from stockflow.lake import Lake
from stockflow.sinks.partitions import overwrite_partitions
from stockflow.sinks.snapshots import SnapshotTable
from stockflow.sources.tables import last_finished, packed_history
from stockflow.storage import children, drop, read_table


def append_history(lake: Lake, history: DataFrame, batch_id: int) -> None:
    """K7: the batch is the last partition level, so a replay replaces itself."""
    overwrite_partitions(
        history.withColumn("batch_id", F.lit(batch_id).cast("bigint")),
        lake.state_history,
        ["business_date", "campaign_id", "batch_id"],
    )


def pack_history(spark: SparkSession, lake: Lake) -> None:
    """K7: move finished batches into files of a good size, by day and campaign.

    The newest finished batch stays as it is, for it may still be replayed. A version of
    the packed table notes up to which batch it holds everything, and readers take the
    rest from the folders of the batches. Those are deleted one packing later, when no
    reader of an older version needs them. Days without new batches are not touched.
    """
    last, table = last_finished(spark, lake), packed_history(spark, lake)
    done = table.upto()
    if last is None or last <= done:
        return
    rows = read_table(spark, lake.state_history, schemas.STATE_HISTORY)
    loose = rows.filter(F.col("batch_id").between(done, last - 1))
    _merge(table, loose, last)
    table.vacuum()
    for folder in children(spark, f"{lake.state_history}/*/*/batch_id=*", whole=True):
        if int(folder.rpartition("=")[2]) < done:
            drop(spark, folder)


def _merge(table: SnapshotTable, loose: DataFrame, upto: int) -> None:
    table.merge(loose, ["business_date", "campaign_id", "event_id"], upto)
