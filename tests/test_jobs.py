from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest

from stockflow import schemas
from stockflow.jobs import arguments
from stockflow.jobs import gold as gold_job
from stockflow.jobs import mart as mart_job
from stockflow.jobs import outgoing as outgoing_job
from stockflow.jobs import report as report_job
from stockflow.jobs import seed as seed_job
from stockflow.jobs import stream as stream_job
from stockflow.lake import Lake
from stockflow.plans import views
from stockflow.sinks import records
from stockflow.sources import messages as M
from stockflow.storage import partition_dir, read_table, shared_folder, work_path
from stockflow.streaming import runner
from stockflow.streaming.sinks import StateSink
from tests.conftest import event, values


def test_business_day_defaults_to_the_local_date():
    late = datetime(2024, 1, 15, 17, 30, tzinfo=timezone.utc)
    assert arguments.business_day(None, late) == "2024-01-16"
    assert arguments.business_day("2024-01-15") == "2024-01-15"
    with pytest.raises(ValueError, match="yyyy-mm-dd"):
        arguments.business_day("15.01.2024")


def test_campaign_is_required(monkeypatch):
    monkeypatch.delenv("CAMPAIGN_ID", raising=False)
    with pytest.raises(ValueError):
        arguments.campaign(None)
    monkeypatch.setenv("CAMPAIGN_ID", "C")
    assert arguments.campaign(None) == "C"


def test_lake_root_is_required(monkeypatch):
    monkeypatch.delenv("LAKE_ROOT", raising=False)
    with pytest.raises(ValueError):
        Lake.from_environment()
    monkeypatch.setenv("LAKE_ROOT", "s3://lake/")
    monkeypatch.setenv("STREAMING_CHECKPOINT_ROOT", "s3://checkpoints/")
    lake = Lake.from_environment()
    assert lake.bronze == "s3://lake/bronze/raw_inventory_events"
    assert lake.checkpoint("q") == "s3://checkpoints/q"


def test_kafka_options_by_mode():
    plain = M.kafka_options("host:9092", "t", "earliest", "plaintext")
    assert plain == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    iam = M.kafka_options("host:9098", max_offsets_per_trigger=5)
    assert iam["kafka.security.protocol"] == "SASL_SSL"
    assert iam["kafka.sasl.mechanism"] == "AWS_MSK_IAM"
    assert iam["maxOffsetsPerTrigger"] == "5"
    assert iam["startingOffsets"] == "latest"
    for bad in (
        {"servers": ""},
        {"servers": "h", "auth_mode": "none"},
        {"servers": "h", "starting_offsets": "middle"},
    ):
        with pytest.raises(ValueError):
            M.kafka_options(**bad)


def test_stream_arguments_come_from_the_environment(monkeypatch):
    monkeypatch.delenv("KAFKA_BOOTSTRAP_SERVERS", raising=False)
    with pytest.raises(ValueError):
        stream_job.parse_arguments([])
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "host:9092")
    args = stream_job.parse_arguments(["--auth-mode", "plaintext", "--unknown", "x"])
    assert (args.topic, args.auth_mode) == ("inventory-events", "plaintext")


def test_partition_dirs_are_named_as_spark_names_them(spark, tmp_path):
    name = "a/b:c=d%e é+&"
    root = str(tmp_path / "t")
    spark.createDataFrame([(1, name)], "v INT, p STRING").write.partitionBy(
        "p"
    ).parquet(root)
    own = spark.read.parquet(partition_dir(root, p=name))
    assert own.count() == 1


def test_work_paths_are_new_and_below_one_folder(spark):
    first, second = work_path(spark, "x"), work_path(spark, "x")
    assert first != second
    assert first.startswith(shared_folder(spark))


def test_records_and_dead_letters(spark, topic, tmp_path):
    from stockflow.functions.events import events_from_messages

    rows = events_from_messages(topic.rows([event(), event(sku_id=None)]))
    rows = rows.withColumn("event_time", rows.event_timestamp.cast("string"))
    (sent,) = records.encode_records(rows).collect()
    assert sent.key == "C|S|W" and '"event_type":"COD_CONFIRMED"' in sent.value
    assert "promotion_id" not in sent.value
    path = str(tmp_path / "failed")
    records.write_dead_letters(rows, path)
    failed = spark.read.json(path)
    assert set(failed.columns) == {"failed_at", "error_message", "event", "date"}
    assert failed.first().error_message.endswith("missing sku_id")


def test_outgoing_records_and_dead_letters_from_files(spark, lake, tmp_path):
    (tmp_path / "promotions.csv").write_text(PROMOTIONS)
    sent = [
        event(event_id="in", promotion_id="P", promotion_applied=True,
              event_time="2024-01-15T11:00:00Z"),
        event(event_id="out", promotion_id="P", promotion_applied=True,
              event_time="2024-01-16T11:00:00Z"),
        event(event_id="unknown", promotion_id="Q", promotion_applied=True),
        event(event_id="plain"),
        event(event_id="lost", warehouse_id=None),
    ]
    (tmp_path / "events.json").write_text("\n".join(map(json.dumps, sent)))
    arguments_ = [
        "--campaign-id", "C", "--lake-root", lake.root,
        "--events", str(tmp_path / "events.json"),
        "--promotion-config", str(tmp_path / "promotions.csv"),
    ]
    outgoing_job.main([*arguments_, "--records", str(tmp_path / "records")])
    found = {}
    for row in spark.read.parquet(str(tmp_path / "records")).collect():
        value = json.loads(row.value)
        found[value["event_id"]] = (row.key, value["unit_price"], value.get("promotion_id"))
    assert found == {
        "in": ("C|S|W", 10.0, "P"), "out": ("C|S|W", 15.0, None),
        "unknown": ("C|S|W", 9.5, None), "plain": ("C|S|W", 9.5, None),
    }
    (failed,) = spark.read.json(lake.failed_records).collect()
    assert failed.event.event_id == "lost" and failed.failed_at.endswith("Z")
    with pytest.raises(ValueError, match="No promotion rows"):
        outgoing_job.main([*arguments_[:1], "nobody", *arguments_[2:], "--records", "x"])


INVENTORY = """campaign_id,sku_id,warehouse_id,product_name,initial_sellable_stock,low_stock_threshold
C,S,W,Phone,20,15
C,T,W,Tablet,9,2
"""
PROMOTIONS = """campaign_id,promotion_id,sku_id,warehouse_id,promotion_name,promotion_quota,sale_price,normal_price,start_time,end_time
C,P,S,W,Sale,9,10,15,2024-01-15T10:00:00Z,2024-01-15T17:00:00Z
"""


def test_a_day_from_seed_to_view(spark, lake, topic, tmp_path):
    """Seed, stream, gold, mart and views over one lake: E1, E2, E3."""
    (tmp_path / "inventory.csv").write_text(INVENTORY)
    (tmp_path / "promotions.csv").write_text(PROMOTIONS)
    day = ["--campaign-id", "C", "--lake-root", lake.root]
    seed_job.main(
        [
            *day,
            "--initial-inventory", str(tmp_path / "inventory.csv"),
            "--promotion-config", str(tmp_path / "promotions.csv"),
            "--snapshot-date", "2024-01-15",
        ]
    )
    topic.send(
        event(event_id="1", quantity=4),
        event(event_id="1", quantity=4),
        event(event_id="2", quantity=0),
        event(event_id="2", quantity=3),
        event(event_id="3", quantity=2, promotion_id="P", promotion_applied=True),
        event(
            event_id="4", event_type="STOCK_REPLENISHED", quantity=5, sku_id="T",
            payment_method="NOT_APPLICABLE", payment_status="NOT_APPLICABLE",
        ),
    )
    sink = StateSink(spark, lake)
    messages = M.read_message_files(spark, topic.path)
    for query in runner.start_all(messages, sink, runner.AVAILABLE_NOW):
        assert query.awaitTermination(240)
    gold_job.main([*day, "--recon-date", "2024-01-15"])
    mart_job.main([*day, "--summary-date", "2024-01-15"])
    views.create_views(spark, lake)
    # Gold counts the valid second copy of event 2, which the stream skips.
    assert values(
        spark.table("vw_reconciliation_dashboard"),
        "sku_id", "batch_recomputed_sellable_stock", "streaming_sellable_stock",
        "status",
    ) == [("S", 11, 14, "MISMATCH"), ("T", 14, 14, "MATCH")]
    assert values(
        spark.table("vw_inventory_dashboard"),
        "sku_id", "opening_sellable_stock", "total_cod_sold_qty",
        "total_replenished_qty", "closing_sellable_stock", "event_count",
    ) == [("S", 20, 9, 0, 11, 3), ("T", 9, 0, 5, 14, 1)]
    output = str(tmp_path / "report")
    report_job.main(
        ["--view", "vw_reconciliation_summary", "--output", output, "--lake-root", lake.root]
    )
    assert values(spark.read.parquet(output), "status", "sku_warehouse_count") == [
        ("MATCH", 1), ("MISMATCH", 1)
    ]
    assert values(sink.current_promotions(), "promotion_consumed_qty") == [(2,)]
    log = read_table(spark, lake.load_log, schemas.LOAD_LOG)
    assert values(log, "target_mart_table", "rows_loaded", "status") == [
        ("mart.fact_daily_inventory_summary", 2, "SUCCESS"),
        ("mart.fact_reconciliation_result", 2, "SUCCESS"),
    ]
