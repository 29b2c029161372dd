"""Streaming sinks: K1-K6, T8, T12, T13."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stockflow import schemas
from stockflow.functions import vocabulary as V
from stockflow.functions.events import is_sale
from stockflow.lake import Lake
from stockflow.operators.dedupe import first_deliveries
from stockflow.operators.running import BLOCK_OFFSETS
from stockflow.operators.state import accepted_columns, apply_events
from stockflow.operators.velocity import (
    WATERMARK,
    WINDOW,
    sales_velocity,
    velocity_scope_rows,
)
from stockflow.sinks.history import append_history, pack_history
from stockflow.sinks.id_ledger import IdLedger
from stockflow.sinks.keyed_log import KeyedLog
from stockflow.sinks.leveled import BUCKETS, FANOUT, LeveledRuns
from stockflow.sinks.projections import (
    bronze_rows,
    silver_invalid_rows,
    silver_movement_rows,
)
from stockflow.sinks.snapshots import SnapshotTable
from stockflow.sources.tables import last_finished
from stockflow.storage import children, drop, exists, make_folder, read_table

# Fixed value: trigger of the keyed sinks; the lake sinks use Spark's default.
KEYED_TRIGGER = {"processingTime": "15 seconds"}
# Batches after which the state history is packed.
PACK_EVERY = 100
Trigger = dict[str, object] | None


def _start(
    rows: DataFrame,
    checkpoint: str,
    mode: str,
    trigger: Trigger,
    sink: Callable,
) -> StreamingQuery:
    name = checkpoint.rpartition("/")[2]
    writer = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if all(query.name != name for query in rows.sparkSession.streams.active):
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    return sink(writer)


def _append(
    rows: DataFrame,
    path: str,
    partition_cols: list[str],
    checkpoint: str,
    trigger: Trigger,
) -> StreamingQuery:
    return _start(
        rows,
        checkpoint,
        "append",
        trigger,
        lambda writer: writer.format("parquet")
        .partitionBy(*partition_cols)
        .start(path),
    )


def start_bronze(events: DataFrame, lake: Lake, trigger: Trigger = None):
    """K1: append raw messages."""
    rows = bronze_rows(events).withColumn("bronze_ingested_at", F.current_timestamp())
    partitions = ["event_date_utc", "event_hour_utc"]
    checkpoint = lake.checkpoint("bronze_raw_inventory_events")
    return _append(rows, lake.bronze, partitions, checkpoint, trigger)


def start_silver_movements(events: DataFrame, lake: Lake, trigger: Trigger = None):
    """K2: append derived events."""
    rows = silver_movement_rows(events).withColumn(
        "silver_processed_at", F.current_timestamp()
    )
    partitions = ["business_date", "business_hour"]
    checkpoint = lake.checkpoint("silver_inventory_movements")
    return _append(rows, lake.silver_movements, partitions, checkpoint, trigger)


def start_silver_invalid(events: DataFrame, lake: Lake, trigger: Trigger = None):
    """K3: append invalid events."""
    rows = silver_invalid_rows(events).withColumn(
        "alert_created_at", F.current_timestamp()
    )
    partitions = ["business_date", "business_hour"]
    checkpoint = lake.checkpoint("silver_inventory_alerts")
    return _append(rows, lake.silver_invalid, partitions, checkpoint, trigger)


def start_velocity(events: DataFrame, lake: Lake, trigger: Trigger = None):
    """K4: append every window once, after the watermark has passed it."""
    rows = sales_velocity(events).withColumn(
        "silver_processed_at", F.current_timestamp()
    )
    partitions = ["window_date", "window_hour"]
    checkpoint = lake.checkpoint("silver_sales_velocity_5m")
    return _append(rows, lake.velocity, partitions, checkpoint, trigger)


class VelocityUpsert:
    """K6: keep the last value per scope and window.

    Open windows are runs of versions, bucketed and merged by level, so a batch writes its
    absolute values only and a replay repeats them in the same place. Windows that the
    watermark has passed change no more: every ``fanout`` batches they move to a table of
    final values by day, and the next merge leaves them out. So neither the
    folders nor the versions that a reader ranks grow with the number of triggers.
    """

    def __init__(self, spark: SparkSession, lake: Lake, fanout: int = FANOUT, buckets: int = BUCKETS):
        self.spark = spark
        self.root = lake.velocity_scopes
        self.keys = ["velocity_scope", "window_start"]
        self.versions = LeveledRuns(
            spark, f"{self.root}/open", f"{schemas.VELOCITY_SCOPE}, batch_id BIGINT",
            self.keys, self._open, fanout, buckets,
        )
        self.final = SnapshotTable(
            spark, f"{self.root}/final", schemas.VELOCITY_SCOPE,
            ["window_date"], ["window_hour", "velocity_scope"],
        )

    def _last(self) -> int | None:
        """The newest batch that is complete."""
        marks = children(self.spark, f"{self.root}/finished/batch=*")
        return max((int(mark.split("=")[1]) for mark in marks), default=None)

    def _closed_before(self, version: int) -> datetime | None:
        """All windows that end by then are final: the end of the last final one."""
        listed = self.final.partitions(version)
        day = listed.agg(F.max("window_date")).first()[0]
        if day is None:
            return None
        rows = self.final.read(version, lambda listed: listed.filter(F.col("window_date") == day))
        return rows.agg(F.max("window_end")).first()[0]

    def _newest(self, rows: DataFrame) -> DataFrame:
        newest = Window.partitionBy(*self.keys).orderBy(F.desc("batch_id"))
        return (
            rows.withColumn("_rank", F.row_number().over(newest))
            .filter(F.col("_rank") == 1)
            .drop("_rank")
        )

    def _open(self, rows: DataFrame, version: int | None = None) -> DataFrame:
        """The newest rows of windows that a version of the final table does not hold."""
        closed = self._closed_before(self.final.version() if version is None else version)
        if closed is not None:
            rows = rows.filter(F.col("window_end") > F.lit(closed))
        return self._newest(rows)

    def _close(self, batch_id: int) -> None:
        """Move windows to the final table that this batch and later ones cannot change.

        A batch drops what is behind the watermark of the batches before it. The newest
        window seen two batches ago started no later than the newest sale then, so the
        stream's watermark is past what lies the delay before that start.
        """
        rows = self._open(self.versions.read(batch_id))
        seen = rows.filter(F.col("batch_id") <= batch_id - 2).agg(F.max("window_start")).first()[0]
        if seen is None:
            return
        behind = F.col("window_end") <= F.lit(seen) - F.expr(f"INTERVAL {WATERMARK}")
        closed = rows.filter(behind).drop("batch_id")
        if not closed.isEmpty():
            self.final.merge(closed, ["window_date", *self.keys])
            self.final.vacuum()

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        now = F.lit(datetime.now(timezone.utc))
        rows = (
            velocity_scope_rows(batch)
            .withColumn("silver_processed_at", now)
            .withColumn("updated_at", now)
            .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        )
        self.versions.forget(batch_id)
        self.versions.write(rows.select(*schemas.column_names(schemas.VELOCITY_SCOPE), "batch_id"), batch_id)
        if (batch_id + 1) % self.versions.fanout == 0:
            self._close(batch_id)
        self.versions.finish(batch_id)
        make_folder(self.spark, f"{self.root}/finished/batch={batch_id}")
        drop(self.spark, f"{self.root}/finished/batch={batch_id - 2}")

    def read(self) -> DataFrame:
        """The newest value per scope and window; days prune folders, hours prune files."""
        last, version = self._last(), self.final.version()
        final = self.final.read(version)
        if last is None:
            return final
        rows = self._open(self.versions.read(last + 1), version).drop("batch_id")
        return final.unionByName(rows)


def read_velocity_scopes(spark: SparkSession, lake: Lake) -> DataFrame:
    """K6: the newest value per scope and window."""
    return VelocityUpsert(spark, lake).read()


class LateSales:
    """The sales that velocity drops because the watermark has closed their window.

    The watermark of a batch comes from the batches before it, as in the stream. It is kept
    per batch, so a replay finds the same one.
    """

    def __init__(self, spark: SparkSession, lake: Lake):
        self.spark = spark
        self.lake = lake

    def _mark(self, batch_id: int) -> str:
        return f"{self.lake.late_sales}_watermark/batch={batch_id}"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        sales = batch.filter(is_sale())
        before = read_table(self.spark, self._mark(batch_id - 1), "at TIMESTAMP").first()
        newest = before and before["at"]
        window_end = F.window("business_timestamp", WINDOW)["end"]
        behind = F.lit(False) if newest is None else (
            window_end <= F.lit(newest) - F.expr(f"INTERVAL {WATERMARK}")
        )
        late = silver_movement_rows(sales.filter(behind))
        late.withColumn("watermark", F.lit(newest).cast("timestamp")).write.mode("overwrite").parquet(
            f"{self.lake.late_sales}/batch_id={batch_id}"
        )
        at = sales.agg(F.greatest(F.max("business_timestamp"), F.lit(newest)).alias("at"))
        at.write.mode("overwrite").parquet(self._mark(batch_id))
        drop(self.spark, self._mark(batch_id - 2))


def start_late_sales(events: DataFrame, lake: Lake, trigger: Trigger = None):
    """Keep the sales that come too late for their window."""
    return _start(
        events,
        lake.checkpoint("late_sales"),
        "append",
        trigger,
        lambda writer: writer.foreachBatch(LateSales(events.sparkSession, lake)).start(),
    )


def start_velocity_upsert(
    events: DataFrame,
    lake: Lake,
    trigger: Trigger = KEYED_TRIGGER,
    fanout: int = FANOUT,
    buckets: int = BUCKETS,
):
    """The same aggregate as K4 in update mode, the newest value per key."""
    return _start(
        sales_velocity(events),
        lake.checkpoint("sales_velocity_5m"),
        "update",
        trigger,
        lambda writer: writer.foreachBatch(
            VelocityUpsert(events.sparkSession, lake, fanout, buckets)
        ).start(),
    )


class StateSink:
    """K5/K7: apply the first deliveries of a micro-batch to stock and promotions.

    The batch's first deliveries are stored before anything is derived from them, and a
    replay of a batch takes up the stored rows. All outputs are folders named after the
    batch, and a batch reads only the state of earlier batches. So a replay after a
    failure at any point repeats the same rows in the same places.

    ``dedupe_horizon`` bounds how long consumed ids are remembered (``IdLedger``).
    """

    def __init__(
        self,
        spark: SparkSession,
        lake: Lake,
        fanout: int = FANOUT,
        buckets: int = BUCKETS,
        block_offsets: int = BLOCK_OFFSETS,
        dedupe_horizon: timedelta | None = None,
        pack_every: int = PACK_EVERY,
    ):
        self.spark = spark
        self.pack_every = pack_every
        self.lake = lake
        self.block_offsets = block_offsets
        self.consumed = IdLedger(spark, lake.consumed_ids, dedupe_horizon, fanout, buckets)
        self.inventory = KeyedLog(
            spark, lake.inventory, schemas.CURRENT_INVENTORY, V.STOCK_KEY, fanout, buckets
        )
        self.promotions = KeyedLog(
            spark, lake.promotions, schemas.PROMOTION_METRICS, V.PROMOTION_KEY, fanout, buckets
        )

    @property
    def _logs(self) -> list[IdLedger | KeyedLog]:
        return [self.consumed, self.inventory, self.promotions]

    def seed(self, inventory: DataFrame, promotions: DataFrame) -> None:
        """B1/B2: insert or replace rows, in effect from the next batch.

        Keys that a running stream may be moving should be seeded while it is
        stopped; keys new to it, such as those of a new campaign, at any time.
        """
        last = self.last_finished()
        upcoming = 0 if last is None else last + 1
        self.inventory.seed(inventory, upcoming)
        self.promotions.seed(promotions, upcoming)

    def _accept(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Store the batch's first deliveries and remember them.

        Of copies in one batch the least arrival wins, as in the batch twin. The batch is
        parsed once; its keys then say which buckets of the ledger to open.
        """
        path = f"{self.lake.accepted}/batch_id={batch_id}"
        if not exists(self.spark, f"{path}/_SUCCESS"):
            now = F.lit(datetime.now(timezone.utc))
            arrivals = accepted_columns(first_deliveries(batch), now).persist()
            try:
                accepted = self.consumed.unseen(arrivals, batch_id)
                accepted.select(*arrivals.columns).write.mode("overwrite").parquet(path)
            finally:
                arrivals.unpersist()
        accepted = self.spark.read.schema(schemas.ACCEPTED).parquet(path)
        self.consumed.write(accepted, batch_id)
        return accepted

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        for log in self._logs:
            log.forget(batch_id)
        accepted = self._accept(batch, batch_id)
        # Both are read several times; the logs are scanned once.
        inventory = self.inventory.before(
            batch_id, accepted.select(*V.STOCK_KEY).distinct()
        ).persist()
        promotions = self.promotions.before(
            batch_id, accepted.select(*V.PROMOTION_KEY).distinct()
        ).persist()
        try:
            self._take(accepted, inventory, promotions, batch_id)
        finally:
            inventory.unpersist()
            promotions.unpersist()
        self._finish(batch_id)

    def _take(
        self,
        accepted: DataFrame,
        inventory: DataFrame,
        promotions: DataFrame,
        batch_id: int,
    ) -> None:
        processed_at = accepted.agg(F.max("processed_at")).first()[0]
        if processed_at is None:
            self.inventory.write(inventory.limit(0), batch_id)
            self.promotions.write(promotions.limit(0), batch_id)
        else:
            self._apply(accepted, inventory, promotions, F.lit(processed_at), batch_id)

    def _apply(
        self,
        accepted: DataFrame,
        inventory: DataFrame,
        promotions: DataFrame,
        processed_at: Column,
        batch_id: int,
    ) -> None:
        """Write all effects of a batch; the ledger is computed once for three."""
        effects = apply_events(
            accepted, inventory, promotions, processed_at, self.block_offsets
        )
        effects.ledger.persist()
        try:
            append_history(self.lake, effects.history, batch_id)
            effects.alerts.write.mode("overwrite").parquet(
                f"{self.lake.alerts}/batch_id={batch_id}"
            )
            self.inventory.write(effects.changed_inventory, batch_id)
            self.promotions.write(effects.changed_promotions, batch_id)
        finally:
            effects.ledger.unpersist()

    def _finish(self, batch_id: int) -> None:
        """Merge what the batch completes, then mark it for readers."""
        for log in self._logs:
            log.finish(batch_id)
        marks = self.lake.finished_batches
        self.spark.range(batch_id, batch_id + 1).write.mode("overwrite").parquet(
            f"{marks}/batch_id={batch_id}"
        )
        # The mark before last is no longer needed; one is always there.
        drop(self.spark, f"{marks}/batch_id={batch_id - 2}")
        if (batch_id + 1) % self.pack_every == 0:
            pack_history(self.spark, self.lake)

    def last_finished(self) -> int | None:
        """The newest batch whose outputs are complete."""
        return last_finished(self.spark, self.lake)

    def _current(self, table: KeyedLog) -> DataFrame:
        last = self.last_finished()
        return table.before(0) if last is None else table.after(last)

    def current_inventory(self) -> DataFrame:
        """Stock per key after the newest complete batch."""
        return self._current(self.inventory)

    def current_promotions(self) -> DataFrame:
        """Promotion counters after the newest complete batch."""
        return self._current(self.promotions)


def start_state(
    events: DataFrame,
    sink: StateSink,
    trigger: Trigger = KEYED_TRIGGER,
):
    """K5: events, applied batch by batch; the sink keeps all state."""
    return _start(
        events,
        sink.lake.checkpoint("current_state"),
        "append",
        trigger,
        lambda writer: writer.foreachBatch(sink).start(),
    )
