from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from stockflow import schemas
from stockflow.functions.events import events_from_messages
from stockflow.operators import dedupe, merge, state
from stockflow.plans.seed import seed_inventory, seed_promotions
from stockflow.sources.messages import read_message_files
from stockflow.sources.tables import read_state_history
from stockflow.storage import exists, read_table
from stockflow.streaming import runner
from stockflow.streaming import sinks as streams
from tests.conftest import event, values

TIMEOUT = 240


def inventory(spark, *rows):
    return seed_inventory(
        spark.createDataFrame(
            [(c, s, "W", "name", stock, threshold) for c, s, stock, threshold in rows],
            schemas.INITIAL_INVENTORY,
        )
    )


def promotions(spark, *rows):
    frame = spark.createDataFrame(
        [(c, p, s, "W", "sale", 9, None, None) for c, p, s in rows],
        "campaign_id STRING, promotion_id STRING, sku_id STRING, warehouse_id STRING,"
        " promotion_name STRING, promotion_quota INT, start_time TIMESTAMP,"
        " end_time TIMESTAMP",
    )
    price = F.lit(None).cast("decimal(18,2)")
    return seed_promotions(
        frame.withColumn("sale_price", price).withColumn("normal_price", price)
    )


def state_sink(spark, lake, **options):
    sink = streams.StateSink(spark, lake, **{"buckets": 4, **options})
    sink.seed(inventory(spark, ("C", "S", 10, 3)), promotions(spark, ("C", "P", "S")))
    return sink


def run_state(spark, topic, sink, files_per_batch=1):
    messages = read_message_files(spark, topic.path, files_per_batch)
    events = events_from_messages(messages)
    runner.run_to_end(
        spark,
        [lambda: streams.start_state(events, sink, runner.AVAILABLE_NOW)],
        TIMEOUT,
    )


def stock(sink):
    return values(
        sink.current_inventory(), "sku_id", "current_sellable_stock", "status",
        "last_event_id",
    )


def alerts(spark, lake):
    return values(
        read_table(spark, lake.alerts, schemas.ALERTS), "alert_type", "event_id",
        "current_sellable_stock", "message",
    )


def sale(event_id, quantity=1, **changes):
    return event(event_id=event_id, quantity=quantity, **changes)


def test_effects_over_several_batches(spark, lake, topic):
    """T3-T7 with restarts, replayed copies, and a base every second batch."""
    sink = state_sink(spark, lake, fanout=2, block_offsets=2)
    topic.send(sale("a", 4), "junk", sale("bad", 0), sale("b", 2))
    run_state(spark, topic, sink)
    topic.send(sale("a", 4), sale("bad", 3), "junk")
    topic.send(sale("c", 2), sale("d", 1, sku_id="X"))
    run_state(spark, topic, sink)
    topic.send(
        sale("e", 3, promotion_id="P", promotion_applied=True),
        sale("f", 1, promotion_id="Q", promotion_applied=True, sku_id="X"),
    )
    topic.send(
        event(
            event_id="g", event_type="PAYMENT_CONFIRMED", payment_method="E_WALLET",
            payment_status="PAID", quantity=5,
        )
    )
    run_state(spark, topic, sink)
    assert sink.last_finished() == 4
    assert stock(sink) == [("S", -1, "OVERSELL", "g")]
    history = read_state_history(spark, lake)
    assert values(
        history, "kafka_offset", "event_id", "previous_sellable_stock",
        "current_sellable_stock", "status",
    ) == [
        (0, "a", 10, 6, "NORMAL"),
        (3, "b", 6, 4, "NORMAL"),
        (7, "c", 4, 2, "LOW_STOCK"),
        (9, "e", 2, -1, "OVERSELL"),
        (11, "g", -1, -1, "OVERSELL"),
    ]
    missing = "Malformed Kafka message or JSON parse failed: missing event_id"
    assert [row[:3] for row in alerts(spark, lake)] == [
        ("INVALID_EVENT", "bad", None),
        ("INVALID_EVENT", None, None),
        ("INVALID_EVENT", None, None),
        ("LOW_STOCK", "c", 2),
        ("OVERSELL", "e", -1),
        ("OVERSELL", "g", -1),
        ("UNKNOWN_PROMOTION", "f", None),
        ("UNKNOWN_SKU", "d", None),
        ("UNKNOWN_SKU", "f", None),
    ]
    messages = {row[0:2]: row[3] for row in alerts(spark, lake)}
    assert messages["INVALID_EVENT", None] == missing
    assert messages["INVALID_EVENT", "bad"] == "invalid_quantity"
    assert messages["OVERSELL", "e"] == "Oversell detected. Current sellable stock=-1"
    assert values(
        sink.current_promotions(), "promotion_consumed_qty", "promotion_cancelled_qty"
    ) == [(3, 0)]


class Crash(RuntimeError):
    pass


@pytest.mark.parametrize(
    "step", ["_accept", "consumed.write", "consumed.finish", "inventory.write", "_finish"]
)
def test_a_crash_at_any_step_loses_and_repeats_nothing(spark, lake, topic, step):
    sink = state_sink(spark, lake)
    topic.send(sale("a", 4))
    run_state(spark, topic, sink)
    topic.send(sale("b", 2), sale("a", 4), sale("bad", 0))

    owner, name = sink, step
    if "." in step:
        owner, name = getattr(sink, step.split(".")[0]), step.split(".")[1]
    original = getattr(owner, name)

    def crash(*args):
        original(*args)
        raise Crash(step)

    setattr(owner, name, crash)
    with pytest.raises(Exception, match="Crash"):
        run_state(spark, topic, sink)
    restarted = streams.StateSink(spark, lake)
    topic.send(sale("c", 1), sale("b", 2))
    run_state(spark, topic, restarted)
    assert stock(restarted) == [("S", 3, "LOW_STOCK", "c")]
    assert values(
        read_state_history(spark, lake), "event_id", "current_sellable_stock"
    ) == [("a", 6), ("b", 4), ("c", 3)]
    assert [row[:2] for row in alerts(spark, lake)] == [
        ("INVALID_EVENT", "bad"), ("LOW_STOCK", "c")
    ]


def test_chunking_does_not_change_the_result(spark, tmp_path, topic):
    from stockflow.lake import Lake

    steps = [sale(f"e{number}", number % 4 + 1) for number in range(12)]
    for at in range(0, 12, 4):
        topic.send(*steps[at : at + 4])
    found = []
    for files in (1, 100):
        lake = Lake(str(tmp_path / f"lake-{files}"))
        sink = state_sink(spark, lake, fanout=2, block_offsets=5)
        run_state(spark, topic, sink, files)
        found.append((stock(sink), alerts(spark, lake)))
    assert found[0] == found[1]
    assert found[0][0][0][1] == 10 - sum(number % 4 + 1 for number in range(12))


def test_the_stream_equals_its_batch_twin(spark, lake, topic):
    sink = state_sink(spark, lake)
    sent = [sale("a", 4), sale("bad", 0), sale("b", 2, sku_id="X"), sale("c", 9)]
    topic.send(*sent)
    topic.send(sent[0], sale("bad", 1))
    run_state(spark, topic, sink)
    events = events_from_messages(
        spark.read.schema(schemas.ENVELOPE).parquet(topic.path)
    )
    now = F.current_timestamp()
    accepted = state.accepted_columns(dedupe.first_deliveries(events), now).cache()
    start = inventory(spark, ("C", "S", 10, 3))
    effects = state.apply_events(
        accepted, start, promotions(spark, ("C", "P", "S")), now
    )
    batch = merge.merged(start, effects.changed_inventory, ["campaign_id", "sku_id"])
    assert stock(sink) == values(
        batch, "sku_id", "current_sellable_stock", "status", "last_event_id"
    )
    assert alerts(spark, lake) == values(
        effects.alerts, "alert_type", "event_id", "current_sellable_stock", "message"
    )


def test_seeding_a_campaign_while_the_stream_goes_on(spark, lake, topic):
    sink = state_sink(spark, lake, fanout=2)
    topic.send(sale("a"), sale("n1", campaign_id="N"))
    run_state(spark, topic, sink)
    sink.seed(inventory(spark, ("N", "S", 7, 0)), promotions(spark, ("N", "P", "S")))
    for name in ("n2", "n3", "n4"):
        topic.send(sale(name, campaign_id="N"))
    run_state(spark, topic, sink)
    assert values(
        sink.current_inventory(), "campaign_id", "current_sellable_stock"
    ) == [("C", 9), ("N", 4)]


def test_the_first_of_copies_in_one_batch_wins(spark, lake, topic):
    """Two payloads of one id share a micro-batch, the later one listed first."""
    sink = state_sink(spark, lake)
    topic.offset = 10
    topic.send(sale("a", quantity=5))
    topic.offset = 0
    topic.send(sale("a"), sale("b"))
    run_state(spark, topic, sink, files_per_batch=10)
    assert stock(sink)[0][:2] == ("S", 8)
    topic.offset = 20
    topic.send(sale("a", quantity=7))
    run_state(spark, topic, sink)
    assert stock(sink)[0][:2] == ("S", 8)


def velocity_rows(spark, path, schema):
    return values(
        spark.read.schema(schema).parquet(path).withColumn(
            "at", F.date_format("window_start", "HH:mm")
        ),
        "at", "order_count", "sold_qty",
    )


def test_a_repeated_velocity_batch_changes_nothing_and_loses_no_scope(spark, lake):
    sink = streams.VelocityUpsert(spark, lake)
    start = datetime(2024, 1, 15, 10, tzinfo=timezone.utc)

    def batch(*sold):
        rows = [
            (start, start + timedelta(minutes=5), "C", sku, "W", None, 5, 1, qty)
            for sku, qty in sold
        ]
        frame = spark.createDataFrame(
            rows,
            "window_start TIMESTAMP, window_end TIMESTAMP, campaign_id STRING, "
            "sku_id STRING, warehouse_id STRING, promotion_id STRING, "
            "window_size_minutes BIGINT, order_count BIGINT, sold_qty BIGINT",
        )
        return frame.withColumn("window_date", F.to_date("window_start")).withColumn(
            "window_hour", F.hour("window_start")
        )

    def sold():
        return values(streams.read_velocity_scopes(spark, lake), "sku_id", "sold_qty")

    assert sold() == []
    sink(batch(("S", 1), ("T", 2)), 0)
    sink(batch(("S", 5)), 1)
    assert sold() == [("S", 5), ("T", 2)]
    sink(batch(("S", 5)), 1)
    assert sold() == [("S", 5), ("T", 2)]


def test_late_sales_leave_velocity_only(spark, lake, topic):
    """A late sale is dropped once the watermark of an earlier batch is past."""
    topic.send(sale("1", event_time="2024-01-15T10:00:00Z"))
    topic.send(sale("2", event_time="2024-01-15T11:00:00Z"))
    topic.send(sale("3", event_time="2024-01-15T11:01:00Z"))
    topic.send(sale("late", event_time="2024-01-15T10:01:00Z"))
    topic.send(sale("4", event_time="2024-01-15T12:00:00Z"))
    events = events_from_messages(read_message_files(spark, topic.path, 1))
    now = runner.AVAILABLE_NOW
    runner.run_to_end(
        spark,
        [
            lambda: streams.start_velocity(events, lake, now),
            lambda: streams.start_velocity_upsert(events, lake, now),
            lambda: streams.start_silver_movements(events, lake, now),
        ],
        TIMEOUT,
    )
    closed = [("17:00", 1, 1), ("18:00", 2, 2)]
    assert velocity_rows(spark, lake.velocity, schemas.VELOCITY) == closed
    scopes = streams.read_velocity_scopes(spark, lake)
    at = F.date_format("window_start", "HH:mm").alias("at")
    assert values(scopes.select(at, "order_count", "sold_qty"), "at", "order_count", "sold_qty") == (
        closed + [("19:00", 1, 1)]
    )
    silver = spark.read.schema(schemas.SILVER_MOVEMENTS).parquet(lake.silver_movements)
    assert silver.count() == 5


def test_all_queries_run_from_one_stream(spark, lake, topic):
    sink = state_sink(spark, lake)
    topic.send(sale("a"), "junk", sale("bad", 0))
    messages = read_message_files(spark, topic.path)
    queries = runner.start_all(messages, sink, runner.AVAILABLE_NOW)
    assert len(queries) == 7
    for query in queries:
        assert query.awaitTermination(TIMEOUT)
    assert spark.read.schema(schemas.BRONZE).parquet(lake.bronze).count() == 3
    invalid = spark.read.schema(schemas.SILVER_INVALID).parquet(lake.silver_invalid)
    assert values(invalid, "event_id", "alert_type") == [
        ("bad", "INVALID_EVENT"), (None, "INVALID_EVENT")
    ]
    assert stock(sink)[0][1] == 9
    for name in ("current_state", "bronze_raw_inventory_events", "sales_velocity_5m"):
        assert exists(spark, lake.checkpoint(name))


def test_a_stream_that_does_not_end_times_out(spark, lake, topic):
    topic.send(sale("a"))
    events = events_from_messages(read_message_files(spark, topic.path))
    with pytest.raises(TimeoutError):
        runner.run_to_end(
            spark, [lambda: streams.start_bronze(events, lake, None)], timeout=1
        )
