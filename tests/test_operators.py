from __future__ import annotations

from collections import defaultdict
from datetime import date, datetime, timezone

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stockflow.functions import events as E
from stockflow.operators import dedupe, merge, promotion, velocity
from stockflow.operators.latest import latest_state
from stockflow.operators.movement import net_movement
from stockflow.operators.running import running_levels
from stockflow.sources.tables import valid_movements
from tests.conftest import EVENT, event, ordered, values

RELAXED = settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


def plan_of(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


def test_keep_first_takes_the_earliest_arrival(spark):
    rows = spark.createDataFrame(
        [("a", 1, 5, "late"), ("a", 0, 9, "first"), ("b", 2, 2, "only")],
        "id STRING, kafka_partition INT, kafka_offset BIGINT, v STRING",
    )
    assert values(dedupe.keep_first(rows, ["id"]), "id", "v") == [
        ("a", "first"), ("b", "only")
    ]


def test_keep_first_limits_each_key_before_the_exchange(spark):
    """A key that owns most rows must not be shipped whole to one task."""
    rows = spark.createDataFrame(
        [("hot", 0, offset) for offset in range(100)],
        "id STRING, kafka_partition INT, kafka_offset BIGINT",
    )
    first = dedupe.keep_first(rows, ["id"])
    below_exchange = plan_of(first).split("Exchange")[-1]
    assert "WindowGroupLimit" in below_exchange
    assert values(first, "id", "kafka_offset") == [("hot", 0)]


def test_messages_without_id_are_all_kept(topic):
    rows = E.events_from_messages(
        topic.rows([EVENT, EVENT, "junk", "junk", event(event_id="")])
    )
    first = dedupe.first_deliveries(rows)
    assert values(first, "event_id", "kafka_offset") == [
        ("", 4), ("evt_1", 0), (None, 2), (None, 3)
    ]


EVENTS = st.lists(
    st.tuples(
        st.sampled_from(["hot", "hot", "hot", "a", "b"]),
        st.integers(0, 2),
        st.integers(0, 60),
        st.integers(-5, 5),
    ),
    unique_by=lambda row: (row[1], row[2]),
    max_size=60,
)


@RELAXED
@given(rows=EVENTS, block=st.sampled_from([1, 3, 7, 1000]))
def test_blocked_running_levels_equal_a_plain_loop(spark, rows, block):
    frame = spark.createDataFrame(
        rows, "k STRING, kafka_partition INT, kafka_offset BIGINT, moved INT"
    )
    openings = spark.createDataFrame([("hot", 10), ("a", 0)], "k STRING, opening INT")
    levels = running_levels(frame, openings, ["k"], "moved", block).withColumn(
        "level", F.col("opening") + F.col("_carry") + F.col("_within")
    )
    stock: dict[str, int] = {"hot": 10, "a": 0}
    expected = []
    for k, partition, offset, moved in sorted(rows, key=lambda r: (r[1], r[2])):
        if k in stock:
            stock[k] += moved
        expected.append((k, partition, offset, stock.get(k)))
    found = values(levels, "k", "kafka_partition", "kafka_offset", "level")
    assert found == ordered(expected)


@RELAXED
@given(
    sold=st.lists(
        st.tuples(
            st.sampled_from(["S", "T"]),
            st.sampled_from(
                ["COD_CONFIRMED", "RETURN_RECEIVED", "STOCK_REPLENISHED"]
            ),
            st.integers(1, 9),
        ),
        max_size=30,
    )
)
def test_net_movement_totals(spark, sold):
    rows = spark.createDataFrame(
        [
            (date(2024, 1, 15), "C", sku, "W", kind, q,
             -q if kind == "COD_CONFIRMED" else q)
            for sku, kind, q in sold
        ],
        "business_date DATE, campaign_id STRING, sku_id STRING, warehouse_id STRING,"
        " event_type STRING, quantity INT, movement_qty INT",
    )
    expected = defaultdict(lambda: [0, 0, 0, 0])
    for sku, kind, q in sold:
        total = expected[sku]
        total[0] += -q if kind == "COD_CONFIRMED" else q
        total[1] += 1
        total[2] += q if kind == "STOCK_REPLENISHED" else 0
        total[3] = total[0] - total[2]
    found = values(
        net_movement(rows), "sku_id", "net_movement_qty", "event_count",
        "replenished_qty", "sales_movement_qty",
    )
    assert found == sorted((sku, *total) for sku, total in expected.items())


def test_velocity_windows_and_null_promotion(topic):
    rows = E.events_from_messages(
        topic.rows(
            [
                event(event_id="1", event_time="2024-01-15T10:00:00Z"),
                event(event_id="2", event_time="2024-01-15T10:04:59Z", order_id=None),
                event(event_id="3", event_time="2024-01-15T10:05:00Z"),
                event(event_id="4", promotion_id="P", quantity=4),
                event(event_id="5", quantity=0),
                event(event_id="6", event_type="RETURN_RECEIVED"),
            ]
        )
    )
    found = velocity.sales_velocity(rows).withColumn(
        "at", F.date_format("window_start", "HH:mm")
    )
    assert values(found, "at", "promotion_id", "order_count", "sold_qty") == [
        ("17:00", "P", 1, 4), ("17:00", None, 1, 2), ("17:05", None, 1, 1)
    ]
    scopes = velocity.velocity_scope_rows(velocity.sales_velocity(rows))
    assert values(scopes.select("velocity_scope").distinct(), "velocity_scope") == [
        ("C#S#W#NO_PROMOTION",), ("C#S#W#P",)
    ]


def promotions(spark):
    return spark.createDataFrame(
        [
            ("C", "P", "S", "W", 10.0, 15.0,
             datetime(2024, 1, 15, 20, tzinfo=timezone.utc),
             datetime(2024, 1, 15, 20, 10, tzinfo=timezone.utc))
        ],
        "campaign_id STRING, promotion_id STRING, sku_id STRING, warehouse_id STRING,"
        " sale_price DOUBLE, normal_price DOUBLE, start_time TIMESTAMP,"
        " end_time TIMESTAMP",
    )


def test_promotion_window_includes_both_ends(spark, topic):
    def applied(event_id, time, promotion_id="P", flag=True):
        return event(
            event_id=event_id, event_time=time, promotion_id=promotion_id,
            promotion_applied=flag, unit_price=1.0,
        )

    rows = E.events_from_messages(
        topic.rows(
            [
                applied("start", "2024-01-15T20:00:00Z"),
                applied("end", "2024-01-15T20:10:00Z"),
                applied("early", "2024-01-15T19:59:59Z"),
                applied("late", "2024-01-15T20:10:01Z"),
                applied("bad time", "soon"),
                applied("unknown", "2024-01-15T20:00:00Z", promotion_id="Q"),
                applied("unnamed", "2024-01-15T20:00:00Z", promotion_id=""),
                applied("off", "2024-01-15T20:00:00Z", flag=False),
            ]
        )
    )
    found = promotion.enforce_promotion_window(rows, promotions(spark))
    assert {
        row.event_id: (
            row.promotion_class, row.promotion_id, row.promotion_applied,
            row.unit_price,
        )
        for row in found.collect()
    } == {
        "start": ("ACTIVE", "P", True, 10.0),
        "end": ("ACTIVE", "P", True, 10.0),
        "early": ("OUTSIDE", None, False, 15.0),
        "late": ("OUTSIDE", None, False, 15.0),
        "bad time": ("OUTSIDE", None, False, 15.0),
        "unknown": ("UNKNOWN", None, False, 1.0),
        "unnamed": ("NOT_APPLIED", "", True, 1.0),
        "off": ("NOT_APPLIED", "P", False, 1.0),
    }


def test_latest_state_prefers_processing_time_then_arrival(spark):
    day, early, late = date(2024, 1, 15), datetime(2024, 1, 15), datetime(2024, 1, 16)
    rows = spark.createDataFrame(
        [
            (day, "C", "S", "W", 5, "NORMAL", "z", late, early, 0, 1),
            (day, "C", "S", "W", 6, "NORMAL", "a", early, late, 0, 2),
            (day, "C", "S", "W", 7, "NORMAL", "b", early, late, 0, 3),
        ],
        "business_date DATE, campaign_id STRING, sku_id STRING, warehouse_id STRING,"
        " current_sellable_stock BIGINT, status STRING, event_id STRING,"
        " event_time TIMESTAMP, processed_at TIMESTAMP, kafka_partition INT,"
        " kafka_offset BIGINT",
    )
    found = latest_state(rows)
    assert values(found, "streaming_sellable_stock", "last_event_id") == [(7, "b")]


def test_gold_counts_a_valid_copy_that_follows_an_invalid_one(topic):
    """The stream consumes an id with its first copy; gold filters first (D3)."""
    rows = E.events_from_messages(topic.rows([event(quantity=0), event(quantity=2)]))
    assert values(valid_movements(rows), "kafka_offset", "quantity") == [(1, 2)]
    assert values(dedupe.first_deliveries(rows), "kafka_offset", "quantity") == [(0, 0)]


def test_merged_updates_inserts_and_keeps(spark):
    schema = "k STRING, v INT"
    target = spark.createDataFrame([("a", 1), ("b", 2)], schema)
    source = spark.createDataFrame([("b", 20), ("c", 30)], schema)
    assert values(merge.merged(target, source, ["k"]), "k", "v") == [
        ("a", 1), ("b", 20), ("c", 30)
    ]


def test_no_plan_crosses_or_is_broadcast_by_hint(spark):
    """Lookups may be broadcast by size, never by demand."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.createDataFrame(
            [("k", 0, offset, 1) for offset in range(10)],
            "k STRING, kafka_partition INT, kafka_offset BIGINT, moved INT",
        )
        openings = spark.createDataFrame([("k", 1)], "k STRING, opening INT")
        for plan in (
            plan_of(running_levels(rows, openings, ["k"], "moved")),
        ):
            assert "SortMergeJoin" in plan
            assert "Broadcast" not in plan and "Cartesian" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
