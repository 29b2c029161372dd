"""Partitioned writes in place: K7, K8, K13."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overwrite_partitions(
    rows: DataFrame,
    path: str,
    partition_cols: list[str],
    sort_cols: list[str] | None = None,
) -> None:
    """K8/L1: replace exactly the partitions that occur in ``rows``.

    The rebalance hint groups each partition's rows for writing, splits partitions
    that are too large for one task, and merges small ones.
    """
    balanced = rows.hint("rebalance", *[F.col(name) for name in partition_cols])
    if sort_cols:
        balanced = balanced.sortWithinPartitions(*sort_cols)
    (
        balanced.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )
