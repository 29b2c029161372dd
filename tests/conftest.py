from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import SparkSession

from stockflow import schemas
from stockflow.lake import Lake
from stockflow.session import prepare
from stockflow.storage import set_shared_folder


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("stockflow-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    set_shared_folder(session)
    yield prepare(session)
    session.stop()


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


EVENT = {
    "event_id": "evt_1",
    "campaign_id": "C",
    "event_time": "2024-01-15T10:00:00Z",
    "event_type": "COD_CONFIRMED",
    "order_id": "ORD_1",
    "sku_id": "S",
    "warehouse_id": "W",
    "quantity": 1,
    "unit_price": 9.5,
    "promotion_id": None,
    "promotion_applied": False,
    "payment_method": "COD",
    "payment_status": "COD_CONFIRMED",
    "reservation_expires_at": None,
    "source": "test",
}


def event(**changes) -> dict:
    return {**EVENT, **changes}


class Topic:
    """Messages with offsets in one topic partition, written file by file."""

    def __init__(self, spark, path):
        self.spark = spark
        self.path = str(path)
        self.offset = 0

    def rows(self, values, partition=0):
        rows = []
        for value in values:
            text = value if isinstance(value, str | None) else json.dumps(value)
            sent = datetime(2024, 1, 15, tzinfo=timezone.utc)
            rows.append(("k", text, "inventory-events", partition, self.offset, sent))
            self.offset += 1
        return self.spark.createDataFrame(rows, schemas.ENVELOPE)

    def send(self, *values):
        self.rows(values).coalesce(1).write.mode("append").parquet(self.path)


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


def ordered(tuples):
    """Tuples in ascending order, with None after everything else."""
    return sorted(tuples, key=lambda row: [(value is None, value) for value in row])


def values(rows, *names):
    """Rows as ordered tuples."""
    return ordered(tuple(row[name] for name in names) for row in rows.collect())
