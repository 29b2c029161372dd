"""Event derivations P1-P9: parse, time columns, movement, validation.

Every function maps a DataFrame to a DataFrame with built-in expressions only, so
one chain serves batch and streaming and stays inside code generation.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow import schemas
from stockflow.functions import vocabulary as V


def business_timezone() -> str:
    """Time zone of the business day, from the environment or the default."""
    return (
        os.getenv("BUSINESS_TIMEZONE")
        or os.getenv("TIMEZONE")
        or V.DEFAULT_BUSINESS_TIMEZONE
    )


def parse_envelope(messages: DataFrame) -> DataFrame:
    """Decode the message and flatten its JSON event.

    A malformed value yields an all-null event, which validation then reports. The
    event leaves a generator of one row: filters on its fields stay above it, where
    a plain projection would let the optimizer copy the JSON parsing into every
    filter that mentions a field.
    """
    decoded = messages.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("json_value"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    )
    event = F.from_json("json_value", schemas.EVENT)
    return decoded.select("*", F.inline(F.array(event)))


def with_event_times(events: DataFrame, timezone: str | None = None) -> DataFrame:
    """Instant, UTC date and hour, local business timestamp, date, hour.

    Text that is not a timestamp gives NULL; it never fails the job.
    """
    timezone = timezone or business_timezone()
    return (
        events.withColumn("event_timestamp", F.try_to_timestamp("event_time"))
        .withColumn(
            "business_timestamp", F.from_utc_timestamp("event_timestamp", timezone)
        )
        .withColumns(
            {
                "event_date": F.to_date("event_timestamp"),
                "event_hour": F.hour("event_timestamp"),
                "business_date": F.to_date("business_timestamp"),
                "business_hour": F.hour("business_timestamp"),
            }
        )
    )


def movement_qty() -> Column:
    """P5: quantity signed by what the event does to sellable stock.

    The subtraction is the non-raising one: the smallest INT has no negative, and
    one such message must not stop a stream.
    """
    kind, quantity = F.col("event_type"), F.col("quantity")
    return (
        F.when(kind.isin(V.DECREASES), F.try_subtract(F.lit(0), quantity))
        .when(kind.isin(V.INCREASES), quantity)
        .when(kind.isin(V.NEUTRAL), F.lit(0))
    )


def invalid_reason() -> Column:
    """The first broken rule, or NULL for a valid event.

    The payment rules keep three-valued logic: where method or status is NULL and
    the other one matches, the rule is neither true nor false and does not fire.
    """
    structural = [
        (F.col("event_id").isNull(), "missing_event_id"),
        (F.col("campaign_id").isNull(), "missing_campaign_id"),
        (F.col("event_timestamp").isNull(), "invalid_event_time"),
        (F.col("event_type").isNull(), "missing_event_type"),
        (F.col("sku_id").isNull(), "missing_sku_id"),
        (F.col("warehouse_id").isNull(), "missing_warehouse_id"),
        (F.col("quantity").isNull(), "missing_quantity"),
        (F.col("quantity") <= 0, "invalid_quantity"),
        (~F.col("event_type").isin(V.EVENT_TYPES), "invalid_event_type"),
    ]
    payment = [
        (
            (F.col("event_type") == kind)
            & ~(
                F.col("payment_method").isin(methods)
                & (F.col("payment_status") == status)
            ),
            reason,
        )
        for kind, methods, status, reason in V.PAYMENT_RULES
    ]
    (first, code), *rest = structural + payment
    return reduce(
        lambda chain, rule: chain.when(rule[0], F.lit(rule[1])),
        rest,
        F.when(first, F.lit(code)),
    )


def with_movement_and_validity(events: DataFrame) -> DataFrame:
    """P5-P7. Validity is derived from the reason, so the two cannot disagree.

    The reason leaves a generator of one row, as the parsed event does: a filter on
    validity then reads it, where it would otherwise repeat the whole rule chain,
    with everything the rules refer to, next to the scan.
    """
    reason = F.explode(F.array(invalid_reason())).alias("invalid_reason")
    return (
        events.withColumn("movement_qty", movement_qty())
        .select("*", reason)
        .withColumn("is_valid_event", F.col("invalid_reason").isNull())
    )


def transform_events(events: DataFrame, timezone: str | None = None) -> DataFrame:
    """The whole derivation chain, for a batch or a streaming DataFrame."""
    return events.transform(with_event_times, timezone).transform(
        with_movement_and_validity
    )


# The projection every sink starts from.
EVENT_OUTPUT = [
    "event_id", "campaign_id", "event_timestamp", "business_timestamp",
    "event_type", "order_id", "sku_id", "warehouse_id", "quantity", "unit_price",
    "promotion_id", "promotion_applied", "payment_method", "payment_status",
    "reservation_expires_at", "source", "movement_qty", "is_valid_event",
    "invalid_reason", "event_date", "business_date", "event_hour",
    "business_hour", "kafka_key", "json_value", "kafka_topic", "kafka_partition",
    "kafka_offset", "kafka_timestamp",
]


def project_output(events: DataFrame) -> DataFrame:
    """The 29 columns handed to the sinks."""
    return events.select(*EVENT_OUTPUT)


def events_from_messages(
    messages: DataFrame, timezone: str | None = None
) -> DataFrame:
    """P1, P8 and P9 in one step."""
    return (
        messages.transform(parse_envelope)
        .transform(transform_events, timezone)
        .transform(project_output)
    )


def is_sale() -> Column:
    """valid sales events that count towards velocity."""
    return (
        F.col("is_valid_event")
        & F.col("event_type").isin(V.SALES)
        & F.col("business_timestamp").isNotNull()
        & F.col("quantity").isNotNull()
        & (F.col("quantity") > 0)
    )


def is_promotional() -> Column:
    """a promotion was applied and is named."""
    return F.coalesce(
        F.col("promotion_applied") & (F.col("promotion_id") != ""), F.lit(False)
    )
