"""Running totals whose hot keys are split into bounded blocks: W4."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.functions import vocabulary as V

BLOCK_OFFSETS = 1_000_000


def with_blocks(rows: DataFrame, block_offsets: int = BLOCK_OFFSETS) -> DataFrame:
    """Cut the offset axis into blocks.

    Offsets are unique within a topic partition, so (key, partition, block) holds
    at most ``block_offsets`` rows however hot the key is.
    """
    return rows.withColumn(
        "_block", F.floor(F.col("kafka_offset") / block_offsets)
    )


def block_carries(
    blocked: DataFrame, keys: list[str], value: str
) -> DataFrame:
    """Per key and block: the total of all earlier blocks, as ``_carry``.

    The totals are summed on the map side first. The window then runs over one row
    per block, a million times fewer than the events of a hot key.
    """
    block = [*keys, "kafka_partition", "_block"]
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("kafka_partition", "_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        blocked.groupBy(*block)
        .agg(F.sum(value).alias("_block_total"))
        .withColumn(
            "_carry", F.coalesce(F.sum("_block_total").over(earlier), F.lit(0))
        )
        .drop("_block_total")
    )


def within_block_sum(
    blocked: DataFrame, keys: list[str], value: str
) -> DataFrame:
    """Running total inside each block, as ``_within``."""
    inside = (
        Window.partitionBy(*keys, "kafka_partition", "_block")
        .orderBy("kafka_offset")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return blocked.withColumn("_within", F.sum(value).over(inside))


def running_levels(
    rows: DataFrame,
    openings: DataFrame,
    keys: list[str],
    value: str,
    block_offsets: int = BLOCK_OFFSETS,
) -> DataFrame:
    """Opening level plus the running total of ``value`` in arrival order.

    ``openings`` has the keys and any columns to attach, unique by key. It is
    joined to the blocks instead of the events, so a hot key meets its opening once
    per block. The last join reuses the partitioning of the block window: the
    events are shuffled once. ``rows`` is read twice and should be a stored table.

    Adds ``_carry`` and ``_within``; their sum plus the opening is the level.
    """
    blocked = with_blocks(rows, block_offsets)
    carries = block_carries(blocked, keys, value).join(openings, keys, "left")
    return within_block_sum(blocked, keys, value).join(
        carries, [*keys, "kafka_partition", "_block"], "left"
    ).drop("_block")
