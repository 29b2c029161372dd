"""The stored topic of the stream queries, and how its streams are run."""

from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from stockflow import queries
from stockflow.streaming import sinks as streams


@pytest.fixture
def tables(spark, tmp_path):
    """A folder with 100 events: 50 messages in each half, two of them sent again."""
    start = datetime(2024, 1, 1)
    rows = [
        (n, start + timedelta(hours=n), n % 7, "purchase", 1.0, f'{{"k": {n}}}')
        for n in range(100)
    ]
    schema = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def lengths(folder):
    return sorted(pq.read_metadata(file).num_rows for file in folder.glob("*.parquet"))


def test_topic_files_have_bounded_length(spark, tables, monkeypatch):
    """one task's stretch of a delivery does not end up in one file."""
    monkeypatch.setattr(queries, "FILE_MESSAGES", 20, raising=False)
    first, second, replays = queries._topic(spark, tables)
    assert lengths(Path(first)) == [10, 20, 20]
    assert lengths(Path(second)) == [10, 20, 20]
    assert lengths(Path(replays)) == [2]


@pytest.mark.parametrize("run", [queries._run_state, queries._run_state_at_once])
def test_state_streams_shuffle_as_the_session_does(spark, tables, monkeypatch, run):
    """without Spark state, no fixed number of partitions takes all rows."""
    name, seen = "spark.sql.shuffle.partitions", []
    take = streams.StateSink.__call__

    def noting(sink, batch, batch_id):
        seen.append(batch.sparkSession.conf.get(name))
        take(sink, batch, batch_id)

    monkeypatch.setattr(streams.StateSink, "__call__", noting)
    run(spark, tables)
    assert set(seen) == {spark.conf.get(name)}
