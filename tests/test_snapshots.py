from __future__ import annotations

import glob
from datetime import date

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stockflow.plans import mart
from stockflow.sinks import snapshots
from stockflow.sinks.snapshots import ConcurrentChange, SnapshotTable
from tests.conftest import values
from tests.test_gold_and_mart import DAY, gold_rows

SCHEMA = "k STRING, v INT, p STRING, q INT"


@pytest.fixture
def table(spark, lake):
    return SnapshotTable(spark, lake.mart("t"), SCHEMA, ["p", "q"], ["p", "k"])


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def held(table, **options):
    return values(table.read(**options), "k", "v", "p", "q")


def test_merge_updates_inserts_and_keeps(spark, table):
    assert held(table) == [] and table.version() == 0
    table.merge(rows(spark, ("a", 1, None, 1), ("b", 2, "x=/ y", 1), ("c", 3, "x", 2), ("d", 4, "y", 1)), ["k", "p", "q"])
    before = {row["p"]: row["write"] for row in table.partitions().collect()}
    table.merge(rows(spark, ("e", 5, None, 1), ("b", 9, "x=/ y", 1), ("f", 6, "y", 2)), ["k", "p", "q"])
    assert held(table) == [
        ("a", 1, None, 1), ("b", 9, "x=/ y", 1), ("c", 3, "x", 2), ("d", 4, "y", 1),
        ("e", 5, None, 1), ("f", 6, "y", 2),
    ]
    listed = table.partitions().collect()
    assert {row["write"] for row in listed if row["p"] == "x"} == {before["x"]}
    assert {(row["p"], row["q"]): row["n_rows"] for row in listed} == {
        (None, 1): 2, ("x=/ y", 1): 1, ("x", 2): 1, ("y", 1): 1, ("y", 2): 1
    }
    assert values(table.changes(1), "p", "q") == [("x=/ y", 1), ("y", 2), (None, 1)]
    assert held(table, version=1)[1] == ("b", 2, "x=/ y", 1)
    assert held(table, only=lambda listed: listed.filter("p = 'y'")) == [("d", 4, "y", 1), ("f", 6, "y", 2)]


def test_readers_see_a_merge_whole_or_not_at_all(spark, table, monkeypatch):
    """A reader between any two steps of a merge over many partitions."""
    old = [(f"k{n}", 0, f"p{n}", 1) for n in range(12)]
    new = [(f"k{n}", 1, f"p{n}", 1) for n in range(12)]
    table.merge(rows(spark, *old), ["k", "p", "q"])
    seen, steps = [], []

    def watched(owner, name):
        original = getattr(owner, name)

        def call(*args, **options):
            seen.append(held(table))
            result = original(*args, **options)
            seen.append(held(table))
            steps.append(name)
            return result

        monkeypatch.setattr(owner, name, call)

    for owner, name in ((table, "_write"), (table, "_commit"), (snapshots, "rename_new"), (snapshots, "merged")):
        watched(owner, name)
    table.merge(rows(spark, *new), ["k", "p", "q"])
    assert sorted(steps) == ["_commit", "_write", "merged", "rename_new"]
    assert {tuple(one) for one in seen} == {tuple(sorted(old)), tuple(sorted(new))}


@pytest.mark.parametrize("step", ["_write", "rename_new"])
def test_a_writer_that_dies_leaves_the_table_as_it_was(spark, table, monkeypatch, step):
    table.merge(rows(spark, ("a", 1, "x", 1), ("b", 2, "y", 1)), ["k", "p", "q"])

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(table if step == "_write" else snapshots, step, die)
        with pytest.raises(RuntimeError):
            table.merge(rows(spark, ("a", 9, "x", 1)), ["k", "p", "q"])
    assert held(table) == [("a", 1, "x", 1), ("b", 2, "y", 1)]
    table.merge(rows(spark, ("c", 3, "x", 1)), ["k", "p", "q"])
    assert held(table) == [("a", 1, "x", 1), ("b", 2, "y", 1), ("c", 3, "x", 1)]


def test_two_writers_keep_both_changes_or_the_second_fails(spark, table, monkeypatch):
    table.merge(rows(spark, ("a", 1, "x", 1), ("b", 2, "y", 1)), ["k", "p", "q"])
    other = SnapshotTable(spark, table.path, SCHEMA, ["p", "q"])
    original = table._write

    def overtaken(*change):
        def write(found):
            stored = original(found)
            other.merge(rows(spark, change), ["k", "p", "q"])
            return stored

        monkeypatch.setattr(table, "_write", write)

    overtaken("b", 8, "y", 1)
    assert table.merge(rows(spark, ("a", 9, "x", 1)), ["k", "p", "q"]) == 3
    assert held(table) == [("a", 9, "x", 1), ("b", 8, "y", 1)]
    overtaken("c", 7, "x", 1)
    with pytest.raises(ConcurrentChange):
        table.merge(rows(spark, ("a", 0, "x", 1)), ["k", "p", "q"])
    assert held(table) == [("a", 9, "x", 1), ("b", 8, "y", 1), ("c", 7, "x", 1)]


def test_staging_never_shows_an_empty_slice(spark, lake, monkeypatch):
    other = date(2024, 1, 14)
    dataset = mart.DAILY_SUMMARY
    load = gold_rows(spark, (DAY, "C", "S", 5), (other, "C", "S", 6), (DAY, "D", "S", 7))
    mart.replace_staging(lake, dataset, load)
    table, seen = mart.staging_table(spark, lake, dataset), []
    original = snapshots.rename_new

    def watched(*args):
        seen.append(values(table.read(), "campaign_id", "closing_sellable_stock"))
        return original(*args)

    monkeypatch.setattr(snapshots, "rename_new", watched)
    again = gold_rows(spark, (DAY, "C", "T", 8))
    staged = mart.replace_staging(lake, dataset, again, campaign_id="C")
    assert seen == [[("C", 5), ("C", 6), ("D", 7)]]
    assert values(staged, "sku_id", "closing_sellable_stock") == [("T", 8)]
    assert values(table.read(), "campaign_id", "closing_sellable_stock") == [("C", 8), ("D", 7)]


def test_old_versions_and_their_files_go(spark, table):
    for n in range(5):
        table.replace(rows(spark, ("a", n, "x", 1)))
    table.replace(rows(spark, ("b", 1, "y", 1)))
    table.vacuum(keep=2)
    assert table.versions() == [5, 6]
    assert held(table) == [("a", 4, "x", 1), ("b", 1, "y", 1)]
    assert len(glob.glob(f"{table.path}/data/write=*/p=*/q=*")) == 2
    table.replace(table.read().limit(0), F.lit(True))
    assert held(table) == []


def test_files_of_a_partition_hold_ranges_that_do_not_overlap(spark, table):
    found = spark.range(4000).select(
        F.format_string("k%05d", F.pmod(F.col("id") * 7919, F.lit(4000))).alias("k"),
        F.lit(1).alias("v"), F.lit("x").alias("p"), F.lit(1).alias("q"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table.replace(found)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = glob.glob(f"{table.path}/data/*/p=x/q=1/*.parquet")
    ranges = []
    for file in files:
        column = pq.ParquetFile(file).metadata.row_group(0).column(0)
        ranges.append((column.statistics.min, column.statistics.max))
    ranges.sort()
    assert len(ranges) == 4
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))
