from __future__ import annotations

from pyspark.sql import functions as F

from stockflow.functions import keys as K
from stockflow.functions import status as S


def one(rows):
    (row,) = rows.collect()
    return row


def test_keys_are_null_when_a_part_is(spark):
    schema = "campaign_id STRING, promotion_id STRING, sku_id STRING, warehouse_id STRING"
    rows = spark.createDataFrame([("C", "P", "S", "W"), ("C", "", None, "W")], schema)
    whole, broken = rows.select(
        K.inventory_key(), K.promotion_key(), K.message_key(), K.velocity_scope()
    ).collect()
    assert tuple(whole) == ("C#S#W", "C#P#S#W", "C|S|W", "C#S#W#P")
    assert tuple(broken) == (None, None, None, None)


def test_empty_and_null_promotions_share_the_stand_in(spark):
    rows = spark.createDataFrame([("",), (None,), ("P",)], "promotion_id STRING")
    names = [row[0] for row in rows.select(K.promotion_or_none()).collect()]
    assert names == ["NO_PROMOTION", "NO_PROMOTION", "P"]


def test_iso_text_and_item_json(spark):
    rows = spark.createDataFrame([(1, None)], "a INT, b STRING").withColumn(
        "t", F.to_timestamp(F.lit("2024-01-15T10:00:00Z"))
    )
    assert one(rows.select(K.iso_utc("t")))[0] == "2024-01-15T10:00:00.000000Z"
    assert one(rows.select(K.item_json("a", "b")))[0] == '{"a":1}'


def test_status_edges(spark):
    levels = [(None, 5), (-1, 5), (0, 5), (5, 5), (6, 5), (0, None), (-1, None)]
    rows = spark.createDataFrame(levels, "stock BIGINT, threshold BIGINT")
    found = rows.select(S.inventory_status(F.col("stock"), F.col("threshold")))
    assert [row[0] for row in found.collect()] == [
        "UNKNOWN", "OVERSELL", "LOW_STOCK", "LOW_STOCK", "NORMAL", "NORMAL", "OVERSELL"
    ]
