"""Audit of the producer contract: P17, P18."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.functions import vocabulary as V


def payment_rule_table(spark: SparkSession) -> DataFrame:
    """Allowed (event type, method, status) triples, eight rows for good."""
    triples = [
        (kind, method, status)
        for kind, methods, status, _ in V.PAYMENT_RULES
        for method in methods
    ] + [(kind, V.NOT_APPLICABLE, V.NOT_APPLICABLE) for kind in V.NOT_APPLICABLE_TYPES]
    return spark.createDataFrame(
        triples, "event_type STRING, payment_method STRING, payment_status STRING"
    )


def payment_rule_violations(events: DataFrame) -> DataFrame:
    """Events whose method and status the contract does not allow.

    Here NULL is a violation, unlike in the stream's own check. The rule table is
    a constant of this module, so broadcasting it is bounded.
    """
    rules = F.broadcast(payment_rule_table(events.sparkSession))
    return events.join(
        rules, ["event_type", "payment_method", "payment_status"], "left_anti"
    ).withColumn(
        "violation",
        F.when(
            F.col("event_type").isin(V.EVENT_TYPES), F.lit("payment_mismatch")
        ).otherwise(F.lit("unknown_event_type")),
    )


def contract_flags() -> dict[str, Column]:
    """One boolean per contract rule, true where the event breaks it.

    Expects the columns of ``transform_events``.
    """
    kind = F.coalesce("event_type", F.lit(""))
    expected_expiry = F.when(
        kind == "STOCK_RESERVED",
        F.col("event_timestamp") + F.expr("INTERVAL 24 HOURS"),
    )
    payment_ok = F.lit(False)
    for event_type, methods, status, _ in V.PAYMENT_RULES:
        payment_ok = payment_ok | (
            (kind == event_type)
            & F.col("payment_method").isin(methods)
            & (F.col("payment_status") == status)
        )
    payment_ok = payment_ok | (
        kind.isin(V.NOT_APPLICABLE_TYPES)
        & (F.col("payment_method") == V.NOT_APPLICABLE)
        & (F.col("payment_status") == V.NOT_APPLICABLE)
    )
    return {
        "unknown_event_type": ~kind.isin(V.EVENT_TYPES),
        "order_id_required": kind.isin(V.ORDER_ID_REQUIRED)
        & F.col("order_id").isNull(),
        "order_id_forbidden": kind.isin(V.ORDER_ID_FORBIDDEN)
        & F.col("order_id").isNotNull(),
        "payment_mismatch": kind.isin(V.EVENT_TYPES)
        & ~F.coalesce(payment_ok, F.lit(False)),
        "quantity_not_positive": ~F.coalesce(F.col("quantity") > 0, F.lit(False)),
        "reservation_expiry": ~expected_expiry.eqNullSafe(
            F.try_to_timestamp("reservation_expires_at")
        ),
    }


def contract_audit(events: DataFrame) -> DataFrame:
    """Number of violations per rule, in one pass over the events."""
    flags = contract_flags()
    counts = events.agg(
        *[F.count_if(flag).alias(name) for name, flag in flags.items()]
    )
    pairs = ", ".join(f"'{name}', {name}" for name in flags)
    return counts.selectExpr(
        f"stack({len(flags)}, {pairs}) AS (rule, violations)"
    )
