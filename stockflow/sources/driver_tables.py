"""Adapter from the generic ``events`` table to inventory messages.

The rules are those of ``FIXTURES.md`` part B. They give every operator input that
grows with the given tables, with invalid events, replays, unknown stock keys and
unknown promotions in fixed proportions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.functions import events as E
from stockflow.functions import keys as K

# Fixed value: offset distance of a replayed copy.
REPLAY_OFFSET = 1_000_000_000
# Fixed value: text form of event times.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory events as sent, with their position in the topic."""
    n, user = F.col("event_id"), F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("int")

    def every(step: int):
        return n % step == 0

    kind = (
        F.when(every(193), "BOGUS")
        .when(
            F.col("event_type") == "signup",
            F.when(n % 10 < 3, "STOCK_REPLENISHED").otherwise("RETURN_RECEIVED"),
        )
        .when(F.col("event_type") == "view", "STOCK_RESERVED")
        .when(
            F.col("event_type") == "purchase",
            F.when(every(3), "PAYMENT_CONFIRMED").otherwise("COD_CONFIRMED"),
        )
        .when(F.col("event_type") == "click", "ORDER_CANCELLED")
        .otherwise("RESERVATION_EXPIRED")
    )
    base = read_events(spark, sf_dir).select(
        n.alias("n"),
        user.alias("u"),
        F.col("ts").cast("timestamp").alias("ts"),
        "value",
        k.alias("k"),
        kind.alias("kind"),
        F.explode(
            F.when(
                every(50), F.array(F.lit(0), F.lit(REPLAY_OFFSET))
            ).otherwise(F.array(F.lit(0)))
        ).alias("shift"),
    )
    n, user, kind = F.col("n"), F.col("u"), F.col("kind")
    method = (
        F.when(every(101), "COD")
        .when(every(103), F.lit(None))
        .when(
            kind.isin("STOCK_RESERVED", "PAYMENT_CONFIRMED", "RESERVATION_EXPIRED"),
            "E_WALLET",
        )
        .when(kind == "COD_CONFIRMED", "COD")
        .when(
            kind == "ORDER_CANCELLED",
            F.when(every(2), "COD").otherwise("E_WALLET"),
        )
        .otherwise("NOT_APPLICABLE")
    )
    status = (
        F.when(every(107), "PENDING")
        .when(kind == "STOCK_RESERVED", "PENDING")
        .when(kind == "PAYMENT_CONFIRMED", "PAID")
        .when(kind == "RESERVATION_EXPIRED", "EXPIRED")
        .when(kind == "COD_CONFIRMED", "COD_CONFIRMED")
        .when(kind == "ORDER_CANCELLED", "CANCELLED")
        .otherwise("NOT_APPLICABLE")
    )
    expiry_due = F.when(
        kind == "STOCK_RESERVED", ~every(109)
    ).otherwise(every(113))
    return base.select(
        F.when(~every(211), F.concat(F.lit("evt_"), n)).alias("event_id"),
        F.concat(F.lit("CAMP_"), n % 2).alias("campaign_id"),
        F.when(every(197), F.lit("not-a-time"))
        .otherwise(F.date_format("ts", ISO_MICROS))
        .alias("event_time"),
        kind.alias("event_type"),
        F.concat(F.lit("ORD_"), user).alias("order_id"),
        F.concat(F.lit("SKU_"), user % 10).alias("sku_id"),
        F.concat(F.lit("WH_"), user % 3).alias("warehouse_id"),
        F.when(F.col("k") <= 97, F.col("k") % 7).alias("quantity"),
        F.col("value").alias("unit_price"),
        F.when(every(4), F.concat(F.lit("PROMO_"), user % 10)).alias("promotion_id"),
        every(4).alias("promotion_applied"),
        method.alias("payment_method"),
        status.alias("payment_status"),
        F.when(
            expiry_due,
            F.date_format(F.col("ts") + F.expr("INTERVAL 24 HOURS"), ISO_MICROS),
        ).alias("reservation_expires_at"),
        F.lit("mock_order_service").alias("source"),
        F.lit("inventory-events").alias("kafka_topic"),
        (user % 3).cast("int").alias("kafka_partition"),
        (n + F.col("shift")).alias("kafka_offset"),
        F.col("ts").alias("kafka_timestamp"),
    )


def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived and validated events, without the round trip through JSON."""
    return E.transform_events(raw_events(spark, sf_dir))


def _stock_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, n = F.col("user_id"), F.col("event_id")
    return (
        read_events(spark, sf_dir)
        .select((n % 2).alias("c"), (user % 10).alias("s"), (user % 3).alias("w"))
        .distinct()
        .select(
            F.concat(F.lit("CAMP_"), "c").alias("campaign_id"),
            F.concat(F.lit("SKU_"), "s").alias("sku_id"),
            F.concat(F.lit("WH_"), "w").alias("warehouse_id"),
            "s",
        )
    )


def initial_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opening stock of every key but those of one SKU, which stay unknown."""
    return _stock_keys(spark, sf_dir).filter(F.col("s") != 9).select(
        "campaign_id",
        "sku_id",
        "warehouse_id",
        F.concat(F.lit("Product "), "s").alias("product_name"),
        (20 + 7 * F.col("s")).cast("int").alias("initial_sellable_stock"),
        F.lit(15).alias("low_stock_threshold"),
    )


def promotion_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One promotion per key, but none for one SKU."""
    return _stock_keys(spark, sf_dir).filter(F.col("s") != 8).select(
        "campaign_id",
        F.concat(F.lit("PROMO_"), "s").alias("promotion_id"),
        "sku_id",
        "warehouse_id",
        F.concat(F.lit("Promotion "), "s").alias("promotion_name"),
        F.lit(100).alias("promotion_quota"),
        F.lit("10.00").cast("decimal(18,2)").alias("sale_price"),
        F.lit("15.00").cast("decimal(18,2)").alias("normal_price"),
        F.to_timestamp(F.lit("2024-01-05T00:00:00Z")).alias("start_time"),
        F.to_timestamp(F.lit("2024-01-20T00:00:00Z")).alias("end_time"),
    )


def daily_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An opening snapshot for every business day on which a key has messages.

    It covers the SKU without inventory too, so that a key can have movements but
    no streamed state.
    """
    return (
        typed_events(spark, sf_dir)
        .filter(F.col("business_date").isNotNull())
        .select(
            F.col("business_date").alias("snapshot_date"),
            "campaign_id",
            "sku_id",
            "warehouse_id",
        )
        .distinct()
        .withColumn("s", F.substring_index("sku_id", "_", -1).cast("int"))
        .select(
            "snapshot_date",
            "campaign_id",
            "sku_id",
            "warehouse_id",
            F.concat(F.lit("Product "), "s").alias("product_name"),
            (20 + 7 * F.col("s")).alias("opening_sellable_stock"),
            F.lit(15).alias("low_stock_threshold"),
        )
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events encoded as topic messages, the input of the streams."""
    raw = raw_events(spark, sf_dir)
    body = raw.columns[: raw.columns.index("kafka_topic")]
    return raw.select(
        K.message_key().alias("key"),
        F.to_json(F.struct(*body)).alias("value"),
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
    )
