"""Duplicate handling: F4, F5, F6."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.functions import vocabulary as V


def keep_first(events: DataFrame, keys: list[str]) -> DataFrame:
    """the first arrival per key, independent of task order.

    Spark turns ``row_number() = 1`` into a group limit on both sides of the
    exchange, so each map task ships at most one copy per key: a key that owns a
    third of all rows costs its reducer one row per map task.
    """
    arrival = Window.partitionBy(*keys).orderBy(*V.ARRIVAL)
    return (
        events.withColumn("_copy", F.row_number().over(arrival))
        .filter(F.col("_copy") == 1)
        .drop("_copy")
    )


def has_event_id() -> Column:
    """an id that is neither NULL nor empty."""
    return F.coalesce("event_id", F.lit("")) != ""


def delivery_key() -> Column:
    """what makes a delivery unique.

    An event is identified by its id. A message without an id is identified by its
    position in the topic, so that every such message is kept and reported, where
    a plain de-duplication would fold them all into one.
    """
    position = F.concat_ws(
        "/", "kafka_topic", F.col("kafka_partition"), F.col("kafka_offset")
    )
    return F.when(
        has_event_id(), F.concat(F.lit("id:"), F.col("event_id"))
    ).otherwise(F.concat(F.lit("at:"), position))


def first_deliveries(events: DataFrame) -> DataFrame:
    """first delivery of every event of a batch, whether valid or not."""
    return (
        events.withColumn("_delivery", delivery_key())
        .transform(keep_first, ["_delivery"])
        .drop("_delivery")
    )
