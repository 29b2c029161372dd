from __future__ import annotations

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from stockflow import schemas
from stockflow.operators.merge import DuplicateKeys
from stockflow.plans import gold, mart, seed, views
from stockflow.sinks.partitions import overwrite_partitions
from stockflow.sources import driver_tables as D
from stockflow.sources.config import (
    read_initial_inventory,
    read_promotion_config,
    read_snapshots,
    require_promotions,
)
from stockflow.sources.tables import read_state_history, valid_movements
from stockflow.operators.movement import net_movement
from stockflow.storage import partition_dir, read_table, stored
from tests.conftest import values

SF = "/root/testdata/sf0.01"
DAY = date(2024, 1, 15)
NOW = datetime(2024, 1, 16, tzinfo=timezone.utc)


def snapshots(spark, *rows):
    return spark.createDataFrame(
        [(DAY, "C", sku, "W", "name", opening, 5) for sku, opening in rows],
        schemas.SNAPSHOT,
    )


def movements(spark, *rows):
    return spark.createDataFrame(
        [(DAY, "C", sku, "W", net, events) for sku, net, events in rows],
        "business_date DATE, campaign_id STRING, sku_id STRING, warehouse_id STRING,"
        " net_movement_qty BIGINT, event_count BIGINT",
    )


def states(spark, *rows):
    return spark.createDataFrame(
        [(DAY, "C", sku, "W", stock) for sku, stock in rows],
        "business_date DATE, campaign_id STRING, sku_id STRING, warehouse_id STRING,"
        " streaming_sellable_stock BIGINT",
    )


def test_reconciliation_outcomes(spark):
    found = gold.reconciliation(
        snapshots(
            spark, ("match", 10), ("off", 10), ("quiet", 10), ("unseen", 10),
            ("null", None),
        ),
        movements(spark, ("match", -3, 2), ("off", 1, 1), ("unseen", 0, 1),
                  ("elsewhere", 5, 5), ("null", 1, 1)),
        states(spark, ("match", 7), ("off", 12), ("null", 4)),
    )
    assert values(
        found, "sku_id", "batch_recomputed_sellable_stock",
        "streaming_sellable_stock", "diff_qty", "status",
    ) == [
        ("match", 7, 7, 0, "MATCH"),
        ("null", None, 4, None, "MISMATCH"),
        ("off", 11, 12, -1, "MISMATCH"),
        ("quiet", 10, 10, 0, "MATCH"),
        ("unseen", 10, 10, 0, "NO_STREAMING_STATE"),
    ]


def test_closing_is_opening_plus_net_movement(spark):
    summary = gold.daily_summary(
        D.daily_snapshots(spark, SF),
        net_movement(valid_movements(D.typed_events(spark, SF))),
    )
    wrong = summary.filter(
        F.col("closing_sellable_stock")
        != F.col("opening_sellable_stock") + F.col("net_movement_qty")
    )
    assert wrong.isEmpty()
    assert summary.filter(F.col("event_count") == 0).count() > 0


def test_fixture_day(spark):
    day = valid_movements(D.typed_events(spark, SF), "2024-01-15")
    net = net_movement(day)
    totals = net.agg(
        F.count("*"), F.sum("net_movement_qty"), F.sum("event_count")
    ).first()
    assert tuple(totals) == (58, 252, 264)


def test_silver_filters_reach_the_scan(spark, lake, capsys):
    names = schemas.column_names(schemas.SILVER_MOVEMENTS)
    row = {name: None for name in names} | {"business_date": DAY, "business_hour": 1}
    one = spark.createDataFrame([tuple(row.values())], schemas.SILVER_MOVEMENTS)
    one.write.partitionBy("business_date", "business_hour").parquet(
        lake.silver_movements
    )
    silver = read_table(spark, lake.silver_movements, schemas.SILVER_MOVEMENTS)
    rows = net_movement(valid_movements(silver, "2024-01-15", "C"))
    rows.explain("formatted")
    details = {
        line.split(":")[0]: line
        for line in capsys.readouterr().out.splitlines()
        if line.startswith(("PartitionFilters", "PushedFilters", "ReadSchema"))
    }
    assert "business_date" in details["PartitionFilters"]
    assert "EqualTo(campaign_id,C)" in details["PushedFilters"]
    assert "EqualTo(is_valid_event,true)" in details["PushedFilters"]
    assert "unit_price" not in details["ReadSchema"]


def initial(spark, tmp_path):
    path = str(tmp_path / "initial.csv")
    with open(path, "w") as out:
        out.write(
            "campaign_id,sku_id,warehouse_id,product_name,"
            "initial_sellable_stock,low_stock_threshold\n"
            "007,S,W,Phone,20,5\n007,T,W,Tablet,4,5\n008,S,W,Phone,1,0\n"
        )
    return path


def test_seeding_keeps_text_keys_and_sets_status(spark, tmp_path):
    rows = read_initial_inventory(spark, initial(spark, tmp_path), "007")
    assert values(
        seed.seed_inventory(rows), "inventory_key", "current_sellable_stock", "status"
    ) == [("007#S#W", 20, "NORMAL"), ("007#T#W", 4, "LOW_STOCK")]


def test_snapshot_round_trip_by_slice(spark, tmp_path):
    root = str(tmp_path / "snapshots")
    rows = read_initial_inventory(spark, initial(spark, tmp_path))
    assert seed.write_snapshot(rows, root, "2024-01-15", "007") == 2
    assert seed.write_snapshot(rows, root, "2024-01-16", "008") == 1
    assert seed.write_snapshot(rows, root, "2024-01-16", "nobody") == 0
    one = read_snapshots(spark, root, "2024-01-15", "007")
    assert values(one, "campaign_id", "sku_id", "opening_sellable_stock") == [
        ("007", "S", 20), ("007", "T", 4)
    ]
    assert read_snapshots(spark, root).count() == 3
    assert read_snapshots(spark, root, "2024-01-16").count() == 1
    assert read_snapshots(spark, root, "2024-01-17").count() == 0
    everything = read_snapshots(spark, root)
    seed.write_snapshots(stored(everything, "again"), root)
    seed.write_snapshot(rows, root, "2024-01-15", "007")
    assert read_snapshots(spark, root).count() == 3
    own = partition_dir(root, snapshot_date="2024-01-15", campaign_id="007")
    files = read_snapshots(spark, root, "2024-01-15", "007").inputFiles()
    assert files and all(own in name for name in files)


def test_snapshot_files_may_begin_with_a_header(spark, tmp_path):
    folder = tmp_path / "s" / "snapshot_date=2024-01-15" / "campaign_id=C"
    folder.mkdir(parents=True)
    (folder / "part.csv").write_text(
        ",".join(schemas.column_names(schemas.SNAPSHOT)) + "\n2024-01-15,C,S,W,\"P, 1\",5,2\n"
    )
    (row,) = read_snapshots(spark, str(tmp_path / "s"), "2024-01-15", "C").collect()
    assert (row.product_name, row.opening_sellable_stock) == ("P, 1", 5)


def test_promotion_config_must_have_rows(spark, tmp_path):
    path = str(tmp_path / "promotions.csv")
    with open(path, "w") as out:
        out.write(
            "campaign_id,promotion_id,sku_id,warehouse_id,promotion_name,"
            "promotion_quota,sale_price,normal_price,start_time,end_time\n"
            "C,P,S,W,Sale,9,10,15,2024-01-15T10:00:00Z,2024-01-15T17:00:00Z\n"
        )
    (row,) = read_promotion_config(spark, path).collect()
    assert float(row.sale_price) == 10.0 and row.start_time is not None
    nobody = read_promotion_config(spark, path, "other")
    assert nobody.isEmpty()
    with pytest.raises(ValueError, match="No promotion rows"):
        require_promotions(nobody, path)


def test_a_day_without_history_has_no_rows(spark, lake):
    assert read_state_history(spark, lake, "2024-01-15", "C").count() == 0


def gold_rows(spark, *rows):
    """Daily summary rows: (day, campaign, sku, closing)."""
    zeros = [0] * 8
    return spark.createDataFrame(
        [
            (sku, "W", "name", 1, *zeros, closing, 1, NOW, day, campaign)
            for day, campaign, sku, closing in rows
        ],
        schemas.GOLD_DAILY_SUMMARY,
    )


def recon_rows(spark, *rows):
    return spark.createDataFrame(
        [
            (sku, "W", 1, 0, 1, 1, 0, "MATCH", NOW, day, campaign)
            for day, campaign, sku in rows
        ],
        schemas.GOLD_RECONCILIATION,
    )


def write_gold_tables(spark, lake, summary, recon):
    overwrite_partitions(
        summary, lake.gold_daily_summary, ["summary_date", "campaign_id"]
    )
    overwrite_partitions(
        recon, lake.gold_reconciliation, ["recon_date", "campaign_id"]
    )


def facts(spark, lake):
    return mart.fact_table(spark, lake, mart.DAILY_SUMMARY).read()


def load_log(spark, lake):
    return read_table(spark, lake.load_log, schemas.LOAD_LOG)


def test_mart_load_updates_inserts_keeps_and_logs(spark, lake):
    other = date(2024, 1, 14)
    campaign = "A/B=c d"
    write_gold_tables(
        spark,
        lake,
        gold_rows(spark, (DAY, campaign, "S", 5), (DAY, campaign, "gone", 7),
                  (other, campaign, "S", 9)),
        recon_rows(spark, (DAY, campaign, "S")),
    )
    mart.load_mart(spark, lake)
    write_gold_tables(
        spark,
        lake,
        gold_rows(spark, (DAY, campaign, "S", 6), (DAY, campaign, "new", 8)),
        recon_rows(spark, (DAY, campaign, "S")),
    )
    load_id = mart.load_mart(spark, lake, "2024-01-15", campaign)
    assert values(facts(spark, lake), "sku_id", "closing_sellable_stock") == [
        ("S", 6), ("S", 9), ("gone", 7), ("new", 8)
    ]
    log = load_log(spark, lake).filter(F.col("load_id").startswith(load_id))
    assert values(log, "load_id", "rows_loaded", "status") == [
        (f"{load_id}_daily_inventory_summary", 2, "SUCCESS"),
        (f"{load_id}_inventory_reconciliation", 1, "SUCCESS"),
    ]


def test_an_empty_slice_clears_staging_but_keeps_the_mart(spark, lake):
    write_gold_tables(
        spark, lake, gold_rows(spark, (DAY, "C", "S", 5)),
        recon_rows(spark, (DAY, "C", "S")),
    )
    mart.load_mart(spark, lake, "2024-01-15", "C")
    empty = gold_rows(spark).limit(0)
    staged = mart.replace_staging(lake, mart.DAILY_SUMMARY, empty, "2024-01-15", "C")
    assert staged.count() == 0
    assert facts(spark, lake).count() == 1


def test_duplicate_keys_stop_the_load_before_the_merge(spark, lake):
    write_gold_tables(
        spark, lake,
        gold_rows(spark, (DAY, "C", "S", 5), (DAY, "C", "S", 6)),
        recon_rows(spark, (DAY, "C", "S")),
    )
    with pytest.raises(DuplicateKeys, match="duplicate_key_count=1"):
        mart.load_mart(spark, lake, "2024-01-15", "C")
    assert facts(spark, lake).count() == 0
    (row,) = load_log(spark, lake).collect()
    assert (row.status, row.rows_loaded) == ("FAILED", 0)
    assert "duplicate_key_count=1" in row.error_message
    assert row.load_id.endswith("_daily_inventory_summary")


def test_a_long_error_is_cut(spark, lake):
    row = mart.failure_log(
        lake, mart.RECONCILIATION, spark, "2024-01-15", "C", "id", NOW, "it's " * 900
    ).first()
    assert len(row.error_message) == 1000 and "it's" in row.error_message
    assert row.business_date == DAY


def test_views_pick_first_and_last_day_of_the_month(spark, lake):
    first, last, next_month = date(2024, 1, 1), date(2024, 1, 31), date(2024, 2, 1)
    write_gold_tables(
        spark, lake,
        gold_rows(spark, (first, "C", "S", 5), (last, "C", "S", 8),
                  (next_month, "C", "S", 1)),
        recon_rows(spark, (first, "C", "S"), (first, "C", "T")),
    )
    mart.load_mart(spark, lake)
    views.create_views(spark, lake)
    monthly = spark.table("vw_monthly_campaign_sku_inventory_summary")
    assert values(
        monthly, "month_date", "first_opening_sellable_stock",
        "latest_closing_sellable_stock", "total_event_count",
    ) == [(first, 1, 8, 2), (next_month, 1, 1, 1)]
    assert values(
        spark.table("vw_reconciliation_summary"), "status", "sku_warehouse_count"
    ) == [("MATCH", 2)]
    assert spark.table("vw_inventory_dashboard").columns == views.INVENTORY_DASHBOARD
    assert (
        spark.table("vw_reconciliation_dashboard").columns
        == views.RECONCILIATION_DASHBOARD
    )
