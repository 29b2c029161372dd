"""Outgoing records and dead letters: K14, K15."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stockflow import schemas
from stockflow.functions import events as E
from stockflow.functions import keys as K
from stockflow.functions import vocabulary as V
from stockflow.operators.promotion import enforce_promotion_window
from stockflow.sources.messages import auth_options

EVENT_COLUMNS = schemas.column_names(schemas.EVENT)


def encode_records(events: DataFrame) -> DataFrame:
    """Message key and JSON value of every event that has a whole key."""
    return events.filter(K.message_key().isNotNull()).select(
        K.message_key().alias("key"),
        F.to_json(F.struct(*EVENT_COLUMNS)).alias("value"),
    )


def dead_letters(events: DataFrame) -> DataFrame:
    """Events without a whole key, with the reason, as JSON."""
    first_missing = F.coalesce(
        *[F.when(F.col(name).isNull(), F.lit(name)) for name in V.STOCK_KEY]
    )
    return events.filter(K.message_key().isNull()).select(
        F.concat(F.lit("Failed to produce event: missing "), first_missing).alias(
            "error_message"
        ),
        F.struct(*EVENT_COLUMNS).alias("event"),
    )


def write_dead_letters(events: DataFrame, path: str) -> None:
    """Append dead letters under the day on which they failed."""
    failed = (
        dead_letters(events)
        .withColumn("failed_at", F.current_timestamp())
        .withColumn("date", F.to_date("failed_at"))
        .withColumn("failed_at", K.iso_utc("failed_at"))
    )
    failed.write.mode("append").partitionBy("date").json(path)


def outgoing_events(events: DataFrame, promotions: DataFrame) -> DataFrame:
    """J5 before K14: raw events with inactive promotions removed and prices set."""
    return enforce_promotion_window(
        E.with_event_times(events), promotions
    ).select(*events.columns)


def _kafka_options(servers: str, topic: str, auth_mode: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        **auth_options(auth_mode),
    }


def write_to_kafka(
    events: DataFrame, servers: str, topic: str, auth_mode: str = "iam"
) -> None:
    """Send encoded events. Needs the Kafka connector."""
    (
        encode_records(events)
        .write.format("kafka")
        .options(**_kafka_options(servers, topic, auth_mode))
        .save()
    )


def start_to_kafka(
    events: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    auth_mode: str = "iam",
) -> StreamingQuery:
    """K14 for a streaming DataFrame. Needs the Kafka connector."""
    return (
        encode_records(events)
        .writeStream.format("kafka")
        .options(**_kafka_options(servers, topic, auth_mode))
        .option("checkpointLocation", checkpoint)
        .start()
    )
