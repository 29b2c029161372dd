"""Campaign seeding job: ``python -m stockflow.jobs.seed``, or this file to spark-submit."""

from __future__ import annotations

import argparse
import logging

from stockflow.jobs.arguments import business_day, campaign
from stockflow.lake import Lake
from stockflow.plans.seed import seed_inventory, seed_promotions, write_snapshot
from stockflow.session import build_session
from stockflow.sources.config import read_initial_inventory, read_promotion_config
from stockflow.streaming.sinks import StateSink

logger = logging.getLogger(__name__)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Seed a campaign")
    parser.add_argument("--campaign-id")
    parser.add_argument("--initial-inventory", required=True)
    parser.add_argument("--promotion-config", required=True)
    parser.add_argument("--snapshot-date")
    parser.add_argument("--lake-root")
    args = parser.parse_args(argv)
    lake = Lake.from_environment(args.lake_root)
    campaign_id = campaign(args.campaign_id)
    spark = build_session("inventory-seed")
    initial = read_initial_inventory(spark, args.initial_inventory, campaign_id)
    promotions = read_promotion_config(spark, args.promotion_config, campaign_id)
    if promotions.isEmpty():
        logger.warning("no promotion rows for campaign %s", campaign_id)
    StateSink(spark, lake).seed(seed_inventory(initial), seed_promotions(promotions))
    count = write_snapshot(
        initial, lake.snapshots, business_day(args.snapshot_date), campaign_id
    )
    logger.info("seeded campaign %s with %s stock keys", campaign_id, count)


if __name__ == "__main__":
    main()
