"""Fan-out of one event stream to its queries: T10."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stockflow.functions.events import events_from_messages
from stockflow.streaming import sinks as S

AVAILABLE_NOW: dict[str, object] = {"availableNow": True}


@contextmanager
def state_partitions(spark: SparkSession, number: int | None):
    """Start streams with a given number of state partitions, or the session's own.

    The number is kept for the life of a checkpoint.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if number is not None:
        spark.conf.set(name, str(number))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def start_all(
    messages: DataFrame,
    sink: S.StateSink,
    trigger: S.Trigger = None,
    partitions: int | None = None,
) -> list[StreamingQuery]:
    """The seven queries over one derived stream.

    ``trigger`` replaces the default triggers of all of them, ``partitions`` the
    session's number of state partitions.
    """
    events = events_from_messages(messages)
    lake = sink.lake
    keyed = trigger or S.KEYED_TRIGGER
    with state_partitions(messages.sparkSession, partitions):
        return [
            S.start_state(events, sink, keyed),
            S.start_bronze(events, lake, trigger),
            S.start_silver_movements(events, lake, trigger),
            S.start_silver_invalid(events, lake, trigger),
            S.start_velocity(events, lake, trigger),
            S.start_velocity_upsert(events, lake, keyed),
            S.start_late_sales(events, lake, trigger),
        ]


def run_to_end(
    spark: SparkSession,
    starters: Iterable[Callable[[], StreamingQuery]],
    timeout: int | None = None,
    partitions: int | None = None,
) -> list[StreamingQuery]:
    """Start queries that stop by themselves and wait for all of them.

    A failure is raised. After ``timeout`` seconds the rest is stopped.
    """
    with state_partitions(spark, partitions):
        queries = [start() for start in starters]
    for query in queries:
        if timeout is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout):
            for rest in queries:
                rest.stop()
            raise TimeoutError(f"stream {query.id} still runs after {timeout} s")
    return queries


def await_any(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait until any query ends, then stop the others."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
