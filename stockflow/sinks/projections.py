"""Row shapes of the lake tables: K1, K2, K3."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow import schemas
from stockflow.functions.status import INVALID_EVENT


def bronze_rows(events: DataFrame) -> DataFrame:
    """K1: raw messages with their position, by UTC date and hour."""
    return events.select(
        "kafka_key",
        "json_value",
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        F.col("event_date").alias("event_date_utc"),
        F.col("event_hour").alias("event_hour_utc"),
    )


def silver_movement_rows(events: DataFrame) -> DataFrame:
    """K2: all derived events, valid or not."""
    stamped = {"silver_processed_at"}
    return events.select(
        *[
            name
            for name in schemas.column_names(schemas.SILVER_MOVEMENTS)
            if name not in stamped
        ]
    )


def silver_invalid_rows(events: DataFrame) -> DataFrame:
    """K3: invalid events only, labelled as alerts."""
    stamped = {"alert_type", "alert_created_at"}
    return (
        events.filter(~F.col("is_valid_event"))
        .select(
            *[
                name
                for name in schemas.column_names(schemas.SILVER_INVALID)
                if name not in stamped
            ]
        )
        .withColumn("alert_type", F.lit(INVALID_EVENT))
    )
