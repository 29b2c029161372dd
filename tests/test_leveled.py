from __future__ import annotations

import glob
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from stockflow import schemas
from stockflow.functions.events import events_from_messages
from stockflow.sinks.history import append_history, pack_history
from stockflow.sinks.id_ledger import IdLedger
from stockflow.sinks.leveled import LeveledRuns
from stockflow.sources.tables import read_state_history
from stockflow.storage import bytes_below
from stockflow.streaming import sinks as streams
from stockflow.streaming.progress import Progress, progress_record
from stockflow.streaming.sinks import LateSales
from tests.conftest import event, values

START = datetime(2024, 1, 15, 3, tzinfo=timezone.utc)


def test_runs_cover_all_batches_and_stay_few(spark, tmp_path):
    runs = LeveledRuns(spark, str(tmp_path / "runs"), "k STRING, v INT", ["k"], fanout=3, buckets=2)
    for batch in range(11):
        runs.forget(batch)
        assert runs.read(batch).count() == batch
        for _ in range(2 if batch in (2, 8) else 1):  # a batch that is replayed
            runs.write(spark.createDataFrame([(f"k{batch}", batch)], "k STRING, v INT"), batch)
            runs.finish(batch)
        assert values(runs.read(batch + 1), "v") == [(n,) for n in range(batch + 1)]
    assert [path.split("layout=3x2/")[1] for path in runs.cover(11)] == [
        "level=0/run=9", "level=0/run=10", "level=2/run=0"
    ]
    assert len(glob.glob(f"{runs.root}/level=*/run=*")) <= 7
    again = LeveledRuns(spark, str(tmp_path / "runs"), "k STRING, v INT", ["k"])
    assert (again.fanout, again.buckets) == (3, 2)
    with pytest.raises(ValueError):
        LeveledRuns(spark, str(tmp_path / "other"), "k STRING", ["k"], fanout=1)


def test_a_reader_opens_the_buckets_of_its_keys_only(spark, tmp_path):
    """The bytes read follow the keys that are looked for, not the table."""
    runs = LeveledRuns(spark, str(tmp_path / "runs"), "k STRING", ["k"], fanout=2, buckets=32)
    rows = spark.range(4000).select(F.col("id").cast("string").alias("k"))
    for batch, part in enumerate(rows.randomSplit([1.0, 1.0, 1.0], 1)):
        runs.write(part, batch)
        runs.finish(batch)
    wanted = spark.createDataFrame([("7",), ("8",)], "k STRING")
    buckets = runs.touched(wanted)
    assert 1 <= len(buckets) <= 2
    found = runs.read(3, buckets)
    assert found.join(wanted, "k", "left_semi").count() == 2
    plan = found._jdf.queryExecution().executedPlan()
    files = found.filter("k IS NOT NULL")
    read = sum(
        bytes_below(spark, file)
        for path in runs.cover(3)
        for bucket in buckets
        for file in glob.glob(f"{path}/bucket={bucket}/*.parquet")
    )
    whole = sum(bytes_below(spark, path) for path in runs.cover(3))
    assert read < 0.15 * whole and files.count() < 0.15 * 4000
    assert "PartitionFilters" in plan.toString()


def arrivals(spark, *rows):
    columns = "event_id STRING, kafka_topic STRING, kafka_partition INT, kafka_offset BIGINT, kafka_timestamp TIMESTAMP"
    return spark.createDataFrame(
        [(name, "t", 0, offset, START + timedelta(hours=hours)) for name, offset, hours in rows], columns
    )


def accept(ledger, rows, batch):
    ledger.forget(batch)
    found = ledger.unseen(rows, batch)
    accepted = sorted(row["kafka_offset"] for row in found.collect())
    ledger.write(rows.filter(F.col("kafka_offset").isin(accepted)), batch)
    ledger.finish(batch)
    return accepted


def test_ids_are_remembered_for_good_or_for_the_horizon(spark, tmp_path):
    batches = [
        [("a", 1, 0), ("b", 2, 1), (None, 3, 1)],
        [("a", 4, 2), ("c", 5, 30)],
        [("a", 6, 31), ("b", 7, 31), ("c", 8, 31), (None, 9, 31)],
        [("a", 10, 32), ("c", 11, 32), ("d", 12, 90)],
        [("d", 13, 91), ("c", 14, 91)],
    ]
    expected = {
        None: [[1, 2, 3], [5], [9], [12], []],
        timedelta(hours=24): [[1, 2, 3], [5], [6, 7, 9], [12], [14]],
    }
    for horizon, accepted in expected.items():
        ledger = IdLedger(spark, str(tmp_path / str(bool(horizon))), horizon, fanout=2, buckets=2)
        found = [accept(ledger, arrivals(spark, *rows), n) for n, rows in enumerate(batches)]
        assert found == accepted
        # A replay of the last batch finds what it found before.
        assert accept(ledger, arrivals(spark, *batches[4]), 4) == accepted[4]
    kept = {row["delivery"] for row in ledger.runs.read(5).collect()}
    assert "id:b" not in kept and "id:d" in kept


def test_remembered_bytes_do_not_grow_with_the_event(spark, tmp_path):
    sizes = []
    for width in (1, 1000):
        rows = arrivals(spark, *[(f"e{n}", n, 0) for n in range(500)]).withColumn("payload", F.repeat(F.lit("x"), width))
        ledger = IdLedger(spark, str(tmp_path / str(width)), buckets=2)
        ledger.write(rows, 0)
        sizes.append(bytes_below(spark, ledger.runs.root))
    assert sizes[0] == sizes[1] and sizes[0] < 40 * 500


def history(spark, batch, *rows):
    found = [(f"{batch}-{n}", day, campaign, batch) for n, (day, campaign) in enumerate(rows)]
    frame = spark.createDataFrame(found, "event_id STRING, business_date STRING, campaign_id STRING, batch BIGINT")
    frame = frame.withColumn("business_date", F.to_date("business_date")).drop("batch")
    have = set(frame.columns)
    kinds = [field.split() for field in schemas.STATE_HISTORY.split(", ")]
    return frame.select(
        "*", *[F.lit(None).cast(kind).alias(name) for name, kind in kinds if name not in have and name != "batch_id"]
    )


def test_history_is_packed_and_read_as_before(spark, lake):
    sink = streams.StateSink(spark, lake, fanout=2, buckets=2)
    expected = []
    for batch in range(12):
        rows = [("2024-01-15", "C"), (f"2024-01-{10 + batch}", "D")]
        append_history(lake, history(spark, batch, *rows), batch)
        spark.range(batch, batch + 1).write.mode("overwrite").parquet(f"{lake.finished_batches}/batch_id={batch}")
        expected += [(f"{batch}-0", batch), (f"{batch}-1", batch)]
        if batch % 3 == 2:
            for _ in range(2 if batch == 5 else 1):
                pack_history(spark, lake)
        assert values(read_state_history(spark, lake), "event_id", "batch_id") == sorted(expected)
    packed = glob.glob(f"{lake.packed_history}/data/*/business_date=2024-01-15/campaign_id=C/*.parquet")
    loose = glob.glob(f"{lake.state_history}/business_date=2024-01-15/campaign_id=C/batch_id=*")
    assert len(packed) <= 3 and len(loose) <= 5
    assert read_state_history(spark, lake, "2024-01-15", "C").count() == 12
    assert sink.last_finished() == 11


def velocity(spark, *rows):
    found = []
    for minutes, sku, sold in rows:
        start = START + timedelta(minutes=minutes)
        found.append((start, start + timedelta(minutes=5), "C", sku, "W", None, 5, 1, sold))
    frame = spark.createDataFrame(
        found,
        "window_start TIMESTAMP, window_end TIMESTAMP, campaign_id STRING, sku_id STRING, "
        "warehouse_id STRING, promotion_id STRING, window_size_minutes BIGINT, order_count BIGINT, sold_qty BIGINT",
    )
    return frame.withColumn("window_date", F.to_date("window_start")).withColumn("window_hour", F.hour("window_start"))


def test_closed_windows_become_final_and_versions_stay_few(spark, lake):
    sink = streams.VelocityUpsert(spark, lake, fanout=2, buckets=2)
    expected = {}
    for batch in range(9):
        at = 30 * batch
        rows = [(at, "S", batch), (at, "T", batch), (at - 30, "S", 100 + batch)]
        for _ in range(2 if batch in (3, 5) else 1):
            sink(velocity(spark, *rows), batch)
        expected |= {(START + timedelta(minutes=m), sku): sold for m, sku, sold in rows}
        found = {
            (row["window_start"].replace(tzinfo=timezone.utc), row["sku_id"]): row["sold_qty"]
            for row in streams.read_velocity_scopes(spark, lake).collect()
        }
        assert found == expected
    assert sink.final.read().count() >= 8
    assert sink.versions.read(9).count() <= 14
    hour = F.col("window_hour") == 3
    assert streams.read_velocity_scopes(spark, lake).filter(hour).count() == 4


def test_late_sales_are_kept_with_the_watermark_they_missed(spark, lake, topic):
    late = LateSales(spark, lake)

    def batch(*times):
        sent = [event(event_id=time, event_time=f"2024-01-15T{time}:00Z") for time in times]
        return events_from_messages(topic.rows([*sent, event(event_id="bad", quantity=0)]))

    late(batch("10:00"), 0)
    for _ in range(2):
        late(batch("11:00", "09:40", "09:50", "09:48"), 1)
    late(batch("10:40", "10:59"), 2)
    rows = spark.read.parquet(lake.late_sales)
    assert values(rows, "event_id", "batch_id") == [("09:40", 1), ("09:48", 1), ("10:40", 2)]


def test_progress_adds_up_state_operators():
    report = {
        "id": "x", "name": None, "batchId": 3, "numInputRows": 7, "processedRowsPerSecond": 2.5,
        "stateOperators": [
            {"numRowsTotal": 4, "memoryUsedBytes": 10, "numRowsDroppedByWatermark": 2},
            {"numRowsTotal": 1, "memoryUsedBytes": 5, "numRowsDroppedByWatermark": 0},
        ],
    }
    assert progress_record(report) == ("x", 3, 7, 2.5, 5, 15, 2)
    progress = Progress(most=2)
    assert progress.records() == []
