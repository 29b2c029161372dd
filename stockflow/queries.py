"""The query registry: every operator over the driver's tables.

Each query takes (spark, sf_dir) and returns a DataFrame. Instants and days are
returned as text, counts and sums as BIGINT, and no wall-clock value is returned,
so that results compare across engines. ``stockflow.oracle`` holds the SQL twins.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow import schemas
from stockflow.functions import contract
from stockflow.functions import events as E
from stockflow.functions import keys as K
from stockflow.functions import vocabulary as V
from stockflow.lake import Lake
from stockflow.operators import dedupe, merge, promotion, state, velocity
from stockflow.operators.latest import latest_state
from stockflow.operators.movement import net_movement
from stockflow.plans import gold, mart, seed, views
from stockflow.session import prepare
from stockflow.sinks import partitions, projections, records
from stockflow.sinks.snapshots import SnapshotTable
from stockflow.sources import driver_tables as D
from stockflow.sources import messages as M
from stockflow.sources import tables
from stockflow.sources.config import (
    read_initial_inventory,
    read_promotion_config,
    read_snapshots,
)
from stockflow.storage import drop, partition_dir, read_table, stored, work_path
from stockflow.streaming import runner
from stockflow.streaming import sinks as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

INSTANT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def processed_at():
    """A fixed processing time, so that a batch result does not depend on the clock."""
    return F.lit(datetime(2024, 1, 31, tzinfo=timezone.utc))


def query(function: Query) -> Query:
    """Register a query under its function name."""

    @wraps(function)
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(function(prepare(spark), sf_dir))

    QUERIES[function.__name__] = prepared
    return prepared


def plain(rows: DataFrame) -> DataFrame:
    """Instants and days as text, whole numbers as BIGINT, prices as DOUBLE."""

    def column(name: str, kind: str):
        if kind == "timestamp":
            return F.date_format(name, INSTANT).alias(name)
        if kind == "date":
            return F.col(name).cast("string").alias(name)
        if kind in ("int", "bigint"):
            return F.col(name).cast("bigint").alias(name)
        if kind.startswith("decimal"):
            return F.col(name).cast("double").alias(name)
        return F.col(name)

    return rows.select(*[column(name, kind) for name, kind in rows.dtypes])


# --- events -------------------------------------------------------------------


@query
def parse_events(spark, sf_dir):
    """Encode to JSON messages and parse them again."""
    return E.parse_envelope(D.messages(spark, sf_dir)).drop(
        "json_value", "kafka_timestamp", "kafka_topic"
    )


@query
def event_times(spark, sf_dir):
    """P2-P4."""
    return D.typed_events(spark, sf_dir).select(
        *V.ARRIVAL,
        "event_timestamp",
        "event_date",
        "event_hour",
        "business_timestamp",
        "business_date",
        "business_hour",
    )


@query
def movement_qty(spark, sf_dir):
    """P5."""
    return D.typed_events(spark, sf_dir).select(
        *V.ARRIVAL, "event_type", "quantity", "movement_qty"
    )


@query
def validation(spark, sf_dir):
    """P6, P7."""
    return D.typed_events(spark, sf_dir).select(
        *V.ARRIVAL, "event_id", "is_valid_event", "invalid_reason"
    )


@query
def invalid_reason_counts(spark, sf_dir):
    """P7 as a summary."""
    return (
        D.typed_events(spark, sf_dir)
        .groupBy(F.coalesce("invalid_reason", F.lit("VALID")).alias("reason"))
        .agg(F.count("*").alias("events"))
    )


def _parsed(spark, sf_dir):
    return E.events_from_messages(D.messages(spark, sf_dir))


def _bronze_output(rows: DataFrame) -> DataFrame:
    """The raw JSON is compared by one of its fields, as engines spell it apart."""
    return rows.select(
        "kafka_key",
        F.get_json_object("json_value", "$.event_type").alias("json_event_type"),
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        "event_date_utc",
        "event_hour_utc",
    )


@query
def bronze_rows(spark, sf_dir):
    """K1 rows."""
    return _bronze_output(projections.bronze_rows(_parsed(spark, sf_dir)))


@query
def silver_movements(spark, sf_dir):
    """P9, K2 rows."""
    return projections.silver_movement_rows(_parsed(spark, sf_dir))


@query
def silver_invalid(spark, sf_dir):
    """K3 rows."""
    return projections.silver_invalid_rows(_parsed(spark, sf_dir)).drop("json_value")


@query
def payment_rule_violations(spark, sf_dir):
    """P17."""
    return contract.payment_rule_violations(D.raw_events(spark, sf_dir)).select(
        *V.ARRIVAL, "event_type", "payment_method", "payment_status", "violation"
    )


@query
def contract_audit(spark, sf_dir):
    """P18."""
    return contract.contract_audit(D.typed_events(spark, sf_dir))


@query
def kafka_record_encode(spark, sf_dir):
    """Number of records and distinct event types per message key."""
    encoded = records.encode_records(D.raw_events(spark, sf_dir))
    return encoded.groupBy("key").agg(
        F.count("value").alias("records"),
        F.countDistinct(F.get_json_object("value", "$.event_type")).alias(
            "event_types"
        ),
    )


def _events_with_gaps(spark, sf_dir):
    """Raw events whose stock key has a hole wherever the event id is missing."""
    gap = F.col("event_id").isNull()
    return D.raw_events(spark, sf_dir).withColumn(
        "sku_id", F.when(~gap, F.col("sku_id"))
    )


@query
def dead_letter(spark, sf_dir):
    """Records without a whole key, written as JSON and read back."""
    path = work_path(spark, "dead-letter")
    records.write_dead_letters(_events_with_gaps(spark, sf_dir), path)
    schema = f"error_message STRING, event STRUCT<{_struct_ddl(schemas.EVENT)}>"
    return (
        spark.read.schema(schema)
        .json(path)
        .select("error_message", "event.event_time", "event.event_type",
                "event.warehouse_id", "event.order_id")
    )


def _struct_ddl(ddl: str) -> str:
    return ", ".join(
        "{}: {}".format(*field.split()) for field in ddl.split(", ")
    )


@query
def outgoing_records(spark, sf_dir):
    """Events priced by their promotion window, sent and parsed again."""
    sent = records.encode_records(
        records.outgoing_events(
            D.raw_events(spark, sf_dir), D.promotion_config(spark, sf_dir)
        )
    )
    event = F.from_json("value", schemas.EVENT)
    return sent.select("key", F.inline(F.array(event))).select(
        "key", "event_id", "event_time", "event_type", "order_id", "promotion_id",
        "promotion_applied", "unit_price",
    )


# --- de-duplication, movement, velocity -----------------------------------------


def _movements(spark, sf_dir):
    return tables.valid_movements(D.typed_events(spark, sf_dir))


@query
def dedup_valid_movements(spark, sf_dir):
    """F1, F2, F4, S4."""
    return _movements(spark, sf_dir).select(
        "event_id", "business_date", *V.STOCK_KEY, *V.ARRIVAL, "event_type",
        "quantity", "movement_qty",
    )


@query
def processed_events(spark, sf_dir):
    """the register of consumed ids."""
    first = dedupe.first_deliveries(D.typed_events(spark, sf_dir))
    return state.processed_events(first.withColumn("processed_at", processed_at())).drop(
        "processed_at"
    )


@query
def net_movement_by_day(spark, sf_dir):
    """A1 for every business day."""
    return net_movement(_movements(spark, sf_dir))


@query
def sales_velocity_5m(spark, sf_dir):
    """A2, F3, T2."""
    return velocity.sales_velocity(D.typed_events(spark, sf_dir))


@query
def velocity_scope_rows(spark, sf_dir):
    """P10, P14."""
    return velocity.velocity_scope_rows(
        velocity.sales_velocity(D.typed_events(spark, sf_dir))
    )


# --- state ----------------------------------------------------------------------


def _accepted(spark, sf_dir):
    """First deliveries as a stored table, as in the streaming sink."""
    first = dedupe.first_deliveries(D.typed_events(spark, sf_dir))
    return stored(state.accepted_columns(first, processed_at()), "accepted")


def _inventory(spark, sf_dir):
    return seed.seed_inventory(D.initial_inventory(spark, sf_dir))


def _promotions(spark, sf_dir):
    return seed.seed_promotions(D.promotion_config(spark, sf_dir))


def _ledger(accepted, spark, sf_dir):
    valid = accepted.filter(dedupe.has_event_id() & F.col("is_valid_event"))
    return state.stock_ledger(valid, _inventory(spark, sf_dir))


def _history(spark, sf_dir):
    return state.state_history(_ledger(_accepted(spark, sf_dir), spark, sf_dir))


def _history_output(history: DataFrame) -> DataFrame:
    return history.drop("history_id", "processed_at", "batch_id")


def _inventory_output(inventory: DataFrame) -> DataFrame:
    return inventory.drop("created_at", "updated_at")


def _alerts_output(alerts: DataFrame) -> DataFrame:
    return alerts.drop("alert_id", "created_at", "batch_id")


def _promotions_output(promotions: DataFrame) -> DataFrame:
    return promotions.drop("created_at", "updated_at")


@query
def state_history(spark, sf_dir):
    """W4, P11, P15, J3, T3."""
    return _history_output(_history(spark, sf_dir))


@query
def history_ids(spark, sf_dir):
    """The stable ids of history rows, which a replay repeats."""
    return _history(spark, sf_dir).select("event_id", "history_id")


@query
def current_inventory(spark, sf_dir):
    """Stock per key after all events."""
    inventory = _inventory(spark, sf_dir)
    changed = state.changed_inventory(
        inventory, _ledger(_accepted(spark, sf_dir), spark, sf_dir)
    )
    return _inventory_output(merge.merged(inventory, changed, V.STOCK_KEY))


@query
def alerts(spark, sf_dir):
    """T6, P16, J3, J4."""
    accepted = _accepted(spark, sf_dir)
    ledger = _ledger(accepted, spark, sf_dir)
    return _alerts_output(
        state.alerts(accepted, ledger, _promotions(spark, sf_dir))
    )


@query
def promotion_metrics(spark, sf_dir):
    """Counters after all events."""
    promotions = _promotions(spark, sf_dir)
    first = dedupe.first_deliveries(D.typed_events(spark, sf_dir))
    changed = state.changed_promotions(promotions, first, processed_at())
    return _promotions_output(merge.merged(promotions, changed, V.PROMOTION_KEY))


@query
def promotion_window(spark, sf_dir):
    """J5, P19, F7."""
    return promotion.enforce_promotion_window(
        D.typed_events(spark, sf_dir), D.promotion_config(spark, sf_dir)
    ).select(
        *V.ARRIVAL, "event_id", "promotion_class", "promotion_id",
        "promotion_applied", "unit_price",
    )


@query
def register_items(spark, sf_dir):
    """Consumed events as JSON items without NULL attributes."""
    first = dedupe.first_deliveries(D.typed_events(spark, sf_dir))
    item = first.filter(dedupe.has_event_id()).withColumn("event_time", K.iso_utc("event_timestamp"))
    names = ["event_id", "campaign_id", "event_type", "quantity", "promotion_id", "event_time"]
    return item.select(*V.ARRIVAL, K.item_json(*names).alias("item"))


def _overlapping_windows(spark, sf_dir) -> DataFrame:
    """Three windows per promotion, of which some overlap, and repeated rows."""
    config = D.promotion_config(spark, sf_dir)

    def window(sale: str, start: str, end: str) -> DataFrame:
        return config.withColumns(
            {
                "sale_price": F.lit(sale).cast("decimal(18,2)"),
                "normal_price": (F.lit(sale).cast("decimal(18,2)") + 5).cast("decimal(18,2)"),
                "start_time": F.to_timestamp(F.lit(start)),
                "end_time": F.to_timestamp(F.lit(end)),
            }
        )

    short = window("8.00", "2024-01-10T00:00:00Z", "2024-01-12T00:00:00Z")
    late = window("9.00", "2024-01-18T12:00:00Z", "2024-01-25T00:00:00Z")
    other = window("7.00", "2024-01-18T12:00:00Z", "2024-01-22T00:00:00Z")
    return config.unionByName(short).unionByName(short).unionByName(late).unionByName(other)


@query
def promotion_windows_overlapping(spark, sf_dir):
    """Several and overlapping windows per key, repeated configuration rows."""
    return promotion.enforce_promotion_windows(
        D.typed_events(spark, sf_dir), _overlapping_windows(spark, sf_dir)
    ).select(
        *V.ARRIVAL, "event_id", "promotion_class", "promotion_id",
        "promotion_applied", "unit_price",
    )


@query
def promotion_window_repeated_keys(spark, sf_dir):
    """Of rows that repeat a key the last one counts; no event is multiplied."""
    return promotion.enforce_promotion_window(
        D.typed_events(spark, sf_dir), _overlapping_windows(spark, sf_dir)
    ).select(*V.ARRIVAL, "promotion_class", "promotion_id", "unit_price")


@query
def latest_state_by_day(spark, sf_dir):
    """The last streamed state per business day and key."""
    return latest_state(_history(spark, sf_dir)).drop("updated_at")


# --- gold, mart, views ------------------------------------------------------------


def _reconciliation(spark, sf_dir):
    return gold.reconciliation(
        D.daily_snapshots(spark, sf_dir),
        net_movement(_movements(spark, sf_dir)),
        latest_state(_history(spark, sf_dir)),
    )


def _daily_summary(spark, sf_dir):
    return gold.daily_summary(
        D.daily_snapshots(spark, sf_dir), net_movement(_movements(spark, sf_dir))
    )


@query
def reconciliation(spark, sf_dir):
    """G1, J1, J2."""
    return _reconciliation(spark, sf_dir)


@query
def daily_summary(spark, sf_dir):
    """G2, J1."""
    return _daily_summary(spark, sf_dir)


@query
def duplicate_keys(spark, sf_dir):
    """Event ids delivered more than once per day and campaign."""
    return merge.duplicate_keys(
        D.typed_events(spark, sf_dir).filter("is_valid_event"),
        ["business_date", "campaign_id", "event_id"],
    )


def _fact(rows: DataFrame) -> DataFrame:
    return rows.withColumn("created_at", processed_at()).withColumn(
        "loaded_at", processed_at()
    )


def _without_stamps(rows: DataFrame) -> DataFrame:
    return rows.drop("created_at", "loaded_at", "latest_loaded_at")


def _merge_into_older(spark, dataset, rows, totals):
    """K10 over stored tables: an older load without one SKU, then the new one.

    The older load has zero totals and lacks ``SKU_3``; the new one lacks the rows
    of ``SKU_5``. So rows are updated, inserted, and kept.
    """
    path = work_path(spark, dataset.fact_table)
    older = rows.filter(F.col("sku_id") != "SKU_3").withColumns(
        {name: F.lit(0).cast("bigint") for name in totals}
    )
    newer = rows.filter(F.col("sku_id") != "SKU_5")
    columns = schemas.column_names(dataset.fact_schema)
    table = SnapshotTable(
        spark, path, dataset.fact_schema, dataset.partitions, list(dataset.sort_columns)
    )
    for load in (older, newer):
        table.merge(stored(_fact(load).select(*columns), "source"), dataset.keys)
    return _without_stamps(table.read())


def _views_over_two_loads(spark, sf_dir) -> Lake:
    """The stored views, refreshed after an older and again after a newer load."""
    lake = Lake(work_path(spark, "lake"))
    parts = (
        (mart.DAILY_SUMMARY, _daily_summary(spark, sf_dir), "event_count"),
        (mart.RECONCILIATION, _reconciliation(spark, sf_dir), "diff_qty"),
    )
    loads = []
    for dataset, found, total in parts:
        rows, day = stored(found, "rows"), F.col(dataset.date_column)
        older = rows.filter("sku_id <> 'SKU_3'").withColumn(total, F.lit(0).cast("bigint"))
        newer = rows.filter((F.col("sku_id") != "SKU_5") & (day >= "2024-01-20"))
        loads.append((mart.fact_table(spark, lake, dataset), dataset.keys, older, newer))
    for number in range(2):
        for table, keys, *both in loads:
            table.merge(stored(_fact(both[number]), "source"), keys)
        views.refresh_views(spark, lake)
    return lake


@query
def monthly_view_incremental(spark, sf_dir):
    """A5, V4: the stored monthly sums after two loads."""
    lake = _views_over_two_loads(spark, sf_dir)
    return views.monthly_table(spark, lake).read()


@query
def reconciliation_view_incremental(spark, sf_dir):
    """A4, V3: the stored outcome counts after two loads."""
    lake = _views_over_two_loads(spark, sf_dir)
    return views.reconciliation_table(spark, lake).read().drop("latest_loaded_at")


@query
def merge_daily_summary(spark, sf_dir):
    """K10, J6, L1 on the daily summary."""
    return _merge_into_older(
        spark,
        mart.DAILY_SUMMARY,
        _daily_summary(spark, sf_dir),
        ["closing_sellable_stock", "event_count"],
    )


@query
def merge_reconciliation(spark, sf_dir):
    """K10, J6, L1 on the reconciliation."""
    return _merge_into_older(
        spark,
        mart.RECONCILIATION,
        _reconciliation(spark, sf_dir),
        ["streaming_sellable_stock", "diff_qty"],
    )


def _gold_lake(spark, sf_dir, date=None, campaign_id=None) -> Lake:
    """Silver, history and snapshots in a lake of their own, and gold from them.

    The lake holds all days and campaigns; gold is made for those asked for.
    """
    lake = Lake(work_path(spark, "lake"))
    events = D.typed_events(spark, sf_dir).withColumn(
        "kafka_key", F.lit(None).cast("string")
    )
    partitions.overwrite_partitions(
        projections.silver_movement_rows(events).withColumn(
            "silver_processed_at", processed_at()
        ),
        lake.silver_movements,
        ["business_date", "business_hour"],
    )
    partitions.overwrite_partitions(
        _history(spark, sf_dir).withColumn("batch_id", F.lit(0).cast("bigint")),
        lake.state_history,
        ["business_date", "campaign_id", "batch_id"],
    )
    seed.write_snapshots(D.daily_snapshots(spark, sf_dir), lake.snapshots)
    gold.run_gold(spark, lake, date, campaign_id)
    return lake


SLICE = {"date": "2024-01-15", "campaign_id": "CAMP_1"}


@query
def gold_job(spark, sf_dir):
    """Gold from stored lake tables, read back."""
    lake = _gold_lake(spark, sf_dir)
    return read_table(
        spark, lake.gold_reconciliation, schemas.GOLD_RECONCILIATION
    ).drop("created_at")


@query
def gold_job_slice(spark, sf_dir):
    """Gold for one day and campaign out of a lake of many."""
    lake = _gold_lake(spark, sf_dir, **SLICE)
    return read_table(
        spark, lake.gold_daily_summary, schemas.GOLD_DAILY_SUMMARY
    ).drop("created_at")


def _mart(spark, lake) -> DataFrame:
    return _without_stamps(mart.fact_table(spark, lake, mart.DAILY_SUMMARY).read())


@query
def mart_job(spark, sf_dir):
    """The mart after the load was run twice."""
    lake = _gold_lake(spark, sf_dir)
    mart.load_mart(spark, lake)
    mart.load_mart(spark, lake)
    return _mart(spark, lake)


@query
def mart_job_slice(spark, sf_dir):
    """One day and campaign of all of gold, loaded into the mart."""
    lake = _gold_lake(spark, sf_dir)
    mart.load_mart(spark, lake, **SLICE)
    return _mart(spark, lake)


def _log(spark, lake) -> DataFrame:
    return read_table(spark, lake.load_log, schemas.LOAD_LOG).select(
        F.regexp_replace("load_id", "_[0-9a-f]{8}_", "_").alias("load_id"),
        "pipeline_name", "target_staging_table", "target_mart_table",
        "business_date", "campaign_id", "rows_loaded", "status", "error_message",
    )


@query
def load_audit(spark, sf_dir):
    """The log of a load of the whole lake."""
    lake = _gold_lake(spark, sf_dir)
    mart.load_mart(spark, lake)
    return _log(spark, lake)


@query
def mart_job_reload(spark, sf_dir):
    """Gold loses a day and campaign between two loads of everything.

    Staging forgets the slice, the log of the second load lacks it, the mart keeps it.
    """
    lake = _gold_lake(spark, sf_dir)
    mart.load_mart(spark, lake)
    for dataset in mart.DATASETS:
        names = {dataset.date_column: SLICE["date"], "campaign_id": SLICE["campaign_id"]}
        drop(spark, partition_dir(dataset.gold_path(lake), **names))
    mart.load_mart(spark, lake)
    staged = mart.staging_table(spark, lake, mart.DAILY_SUMMARY).read()
    logged = _log(spark, lake).filter("load_id LIKE '%daily_inventory_summary'")

    def counted(rows: DataFrame, date: str, what: str, n) -> DataFrame:
        return rows.groupBy(F.col(date).alias("business_date"), "campaign_id").agg(
            n.cast("bigint").alias("n")
        ).withColumn("what", F.lit(what))

    return (
        counted(staged, "summary_date", "staged", F.count("*"))
        .unionByName(counted(_mart(spark, lake), "summary_date", "mart", F.count("*")))
        .unionByName(counted(logged, "business_date", "logged", F.sum("rows_loaded")))
    )


@query
def load_failure_audit(spark, sf_dir):
    """The log of a load that duplicate keys stop.

    Every gold row of the first dataset is there twice; the error counts its keys.
    """
    lake = _gold_lake(spark, sf_dir)
    path = mart.DAILY_SUMMARY.gold_path(lake)
    again = stored(read_table(spark, path, schemas.GOLD_DAILY_SUMMARY), "again")
    again.write.mode("append").partitionBy(*mart.DAILY_SUMMARY.partitions).parquet(path)
    try:
        mart.load_mart(spark, lake)
    except merge.DuplicateKeys:
        return _log(spark, lake)
    raise AssertionError("the load accepted duplicate keys")


@query
def inventory_dashboard(spark, sf_dir):
    """V1."""
    return _without_stamps(
        views.inventory_dashboard(_fact(_daily_summary(spark, sf_dir)))
    )


@query
def reconciliation_dashboard(spark, sf_dir):
    """V2."""
    return _without_stamps(
        views.reconciliation_dashboard(_fact(_reconciliation(spark, sf_dir)))
    )


@query
def reconciliation_summary(spark, sf_dir):
    """V3, A4."""
    return _without_stamps(
        views.reconciliation_summary(_fact(_reconciliation(spark, sf_dir)))
    )


@query
def monthly_summary(spark, sf_dir):
    """V4, A5, W2, W3."""
    return views.monthly_summary(_fact(_daily_summary(spark, sf_dir)))


# --- seeding ------------------------------------------------------------------------


@query
def seed_inventory(spark, sf_dir):
    """B1, S6, P10, P11."""
    return _inventory_output(_inventory(spark, sf_dir))


@query
def seed_promotions(spark, sf_dir):
    """B2, S7."""
    return _promotions_output(_promotions(spark, sf_dir))


def _as_csv(spark, rows, name) -> str:
    path = work_path(spark, name)
    rows.write.option("header", True).csv(path)
    return path


@query
def seed_inventory_csv(spark, sf_dir):
    """The same from configuration files."""
    path = _as_csv(spark, D.initial_inventory(spark, sf_dir), "inventory")
    return _inventory_output(seed.seed_inventory(read_initial_inventory(spark, path)))


@query
def seed_promotions_csv(spark, sf_dir):
    """The same from configuration files."""
    path = _as_csv(spark, D.promotion_config(spark, sf_dir), "promotions")
    return _promotions_output(seed.seed_promotions(read_promotion_config(spark, path)))


@query
def opening_snapshot(spark, sf_dir):
    """Written as CSV and read back."""
    root = work_path(spark, "snapshots")
    initial = D.initial_inventory(spark, sf_dir)
    for day in ("2024-01-01", "2024-01-02", "2024-01-01"):
        seed.write_snapshots(seed.opening_snapshot(initial, day), root)
    return read_snapshots(spark, root, "2024-01-01")


# --- streams ------------------------------------------------------------------------

# State partitions of the streams below, whose state is small.
STATE_PARTITIONS = 8
# Messages of a topic file, so that a delivery has as many files as its size asks for.
FILE_MESSAGES = 100_000
_topics: dict[tuple[str, str], list[str]] = {}


def _topic(spark, sf_dir) -> list[str]:
    """The messages as a stored topic: two halves by offset, then the replays.

    Returns one folder per delivery. The encoding is done once per session.
    """
    name = (spark.sparkContext.applicationId, sf_dir)
    if name not in _topics:
        sent = D.messages(spark, sf_dir)
        middle = (
            D.read_events(spark, sf_dir)
            .agg(F.expr("floor((min(event_id) + max(event_id)) / 2)"))
            .first()[0]
        )
        delivery = (
            F.when(F.col("offset") <= middle, 0)
            .when(F.col("offset") < D.REPLAY_OFFSET, 1)
            .otherwise(2)
        )
        root = work_path(spark, "topic")
        _write_messages(sent.withColumn("delivery", delivery), root, "delivery")
        _topics[name] = [f"{root}/delivery={number}" for number in range(3)]
    return _topics[name]


def _write_messages(sent: DataFrame, path: str, *partition_cols: str) -> None:
    """Topic files of bounded length: a reader gets them in even shares.

    Tasks that write hold stretches of the topic, so a delivery is in some of them only.
    """
    writer = sent.write.option("maxRecordsPerFile", FILE_MESSAGES)
    writer.partitionBy(*partition_cols).parquet(path)


def _run_once(spark, sf_dir, starter) -> Lake:
    """One stream over the whole topic, run until it has caught up."""
    lake = Lake(work_path(spark, "stream"))
    root = _topic(spark, sf_dir)[0].rsplit("/", 1)[0]
    events = E.events_from_messages(M.read_message_files(spark, f"{root}/*"))
    runner.run_to_end(
        spark,
        [lambda: starter(events, lake, runner.AVAILABLE_NOW)],
        partitions=STATE_PARTITIONS,
    )
    return lake


def _run_state(spark, sf_dir, **options) -> tuple[Lake, streams.StateSink]:
    """The state stream over three deliveries, restarted between them.

    Every run resumes from the checkpoint and finds one more folder of messages. The
    stream keeps its state in the sink's tables, not in Spark's state store, so its
    shuffles have the session's number of partitions and no fixed one.
    """
    lake = Lake(work_path(spark, "stream"))
    sink = streams.StateSink(spark, lake, fanout=2, buckets=STATE_PARTITIONS, **options)
    sink.seed(_inventory(spark, sf_dir), _promotions(spark, sf_dir))
    inbox = f"{lake.root}/inbox"
    for number, folder in enumerate(_topic(spark, sf_dir)):
        delivered = spark.read.schema(schemas.ENVELOPE).parquet(folder)
        _write_messages(delivered, f"{inbox}/delivery-{number}")
        events = E.events_from_messages(M.read_message_files(spark, f"{inbox}/*"))
        runner.run_to_end(
            spark,
            [lambda: streams.start_state(events, sink, runner.AVAILABLE_NOW)],
        )
    return lake, sink


def _run_state_at_once(spark, sf_dir) -> Lake:
    """The state stream over all deliveries in one micro-batch of several files."""
    lake = Lake(work_path(spark, "stream"))
    sink = streams.StateSink(spark, lake, buckets=STATE_PARTITIONS)
    sink.seed(_inventory(spark, sf_dir), _promotions(spark, sf_dir))
    root = _topic(spark, sf_dir)[0].rsplit("/", 1)[0]
    events = E.events_from_messages(M.read_message_files(spark, f"{root}/*"))
    runner.run_to_end(
        spark,
        [lambda: streams.start_state(events, sink, runner.AVAILABLE_NOW)],
    )
    return lake


@query
def stream_bronze(spark, sf_dir):
    """K1, T8, T9, S1."""
    lake = _run_once(spark, sf_dir, streams.start_bronze)
    return _bronze_output(spark.read.schema(schemas.BRONZE).parquet(lake.bronze))


@query
def stream_silver(spark, sf_dir):
    """K2, T11."""
    lake = _run_once(spark, sf_dir, streams.start_silver_movements)
    return spark.read.schema(schemas.SILVER_MOVEMENTS).parquet(
        lake.silver_movements
    ).drop("silver_processed_at")


@query
def stream_invalid(spark, sf_dir):
    """K3."""
    lake = _run_once(spark, sf_dir, streams.start_silver_invalid)
    return spark.read.schema(schemas.SILVER_INVALID).parquet(
        lake.silver_invalid
    ).drop("alert_created_at", "json_value")


@query
def stream_velocity(spark, sf_dir):
    """Windows that the watermark has closed."""
    lake = _run_once(spark, sf_dir, streams.start_velocity)
    return spark.read.schema(schemas.VELOCITY).parquet(lake.velocity).drop(
        "silver_processed_at"
    )


@query
def stream_velocity_upsert(spark, sf_dir):
    """The last value of every window, closed or not."""
    lake = _run_once(spark, sf_dir, streams.start_velocity_upsert)
    return streams.read_velocity_scopes(spark, lake).drop(
        "silver_processed_at", "updated_at"
    )


def _run_by_time(spark, sf_dir, starter) -> Lake:
    """A stream over the topic in order of message time, eight days a micro-batch."""
    lake = Lake(work_path(spark, "stream"))
    sent = D.messages(spark, sf_dir)
    days = F.datediff(F.to_date("timestamp"), F.lit("2024-01-01").cast("date"))
    root = work_path(spark, "messages")
    sent.withColumn("part", F.floor(days / 8)).repartition("part").write.partitionBy("part").parquet(root)
    for part in range(4):
        folder = f"{lake.root}/inbox/{part}"
        spark.read.schema(schemas.ENVELOPE).parquet(f"{root}/part={part}").write.parquet(folder)
        events = E.events_from_messages(M.read_message_files(spark, f"{lake.root}/inbox/*"))
        runner.run_to_end(
            spark,
            [lambda events=events: starter(events, lake, runner.AVAILABLE_NOW)],
            partitions=STATE_PARTITIONS,
        )
    return lake


@query
def stream_velocity_compacted(spark, sf_dir):
    """Windows behind the watermark become final every second batch."""

    def start(events, lake, trigger):
        return streams.start_velocity_upsert(events, lake, trigger, fanout=2, buckets=STATE_PARTITIONS)

    lake = _run_by_time(spark, sf_dir, start)
    return streams.read_velocity_scopes(spark, lake).drop(
        "silver_processed_at", "updated_at"
    )


@query
def stream_late_sales(spark, sf_dir):
    """Sales whose window the watermark of earlier deliveries has closed."""
    lake = Lake(work_path(spark, "stream"))
    for number, folder in enumerate(_topic(spark, sf_dir)):
        delivered = spark.read.schema(schemas.ENVELOPE).parquet(folder)
        _write_messages(delivered, f"{lake.root}/inbox/delivery-{number}")
        events = E.events_from_messages(M.read_message_files(spark, f"{lake.root}/inbox/*"))
        runner.run_to_end(
            spark,
            [lambda events=events: streams.start_late_sales(events, lake, runner.AVAILABLE_NOW)],
        )
    rows = read_table(spark, lake.late_sales, f"{schemas.SILVER_MOVEMENTS}, watermark TIMESTAMP")
    return rows.select(*V.ARRIVAL, "event_id", "business_timestamp", "watermark")


@query
def stream_bounded_dedupe(spark, sf_dir):
    """ids are remembered for ten days of message time."""
    lake, _ = _run_state(spark, sf_dir, dedupe_horizon=timedelta(days=10))
    rows = read_table(spark, lake.accepted, schemas.ACCEPTED)
    return rows.select(*V.ARRIVAL, "event_id", "event_type")


@query
def stream_history_packed(spark, sf_dir):
    """The state history, packed after every second batch."""
    lake, _ = _run_state(spark, sf_dir, pack_every=2)
    return _history_output(tables.read_state_history(spark, lake))


@query
def stream_state(spark, sf_dir):
    """Stock per key after three deliveries."""
    _, sink = _run_state(spark, sf_dir)
    return _inventory_output(sink.current_inventory())


@query
def stream_history(spark, sf_dir):
    """The state history the stream has written."""
    lake, _ = _run_state(spark, sf_dir)
    return _history_output(tables.read_state_history(spark, lake))


@query
def stream_history_one_batch(spark, sf_dir):
    """T4, K7: copies of an event share a micro-batch; the first arrival counts."""
    lake = _run_state_at_once(spark, sf_dir)
    return _history_output(tables.read_state_history(spark, lake))


@query
def stream_alerts_one_batch(spark, sf_dir):
    """The alerts of the same."""
    lake = _run_state_at_once(spark, sf_dir)
    return _alerts_output(tables.read_alerts(spark, lake))


@query
def stream_alerts(spark, sf_dir):
    """The alerts the stream has written."""
    lake, _ = _run_state(spark, sf_dir)
    return _alerts_output(tables.read_alerts(spark, lake))


@query
def stream_promotions(spark, sf_dir):
    """T5: promotion counters after three deliveries."""
    _, sink = _run_state(spark, sf_dir)
    return _promotions_output(sink.current_promotions())
