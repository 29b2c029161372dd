"""Mart load job: ``python -m stockflow.jobs.mart``, or this file to spark-submit."""

from __future__ import annotations

import argparse

from stockflow.jobs.arguments import business_day, campaign
from stockflow.lake import Lake
from stockflow.plans.mart import load_mart
from stockflow.plans.views import refresh_views
from stockflow.session import build_session


def main(argv: list[str] | None = None) -> str:
    parser = argparse.ArgumentParser(description="Load gold tables into the mart")
    parser.add_argument("--summary-date")
    parser.add_argument("--recon-date")
    parser.add_argument("--campaign-id")
    parser.add_argument("--lake-root")
    parser.add_argument(
        "--all", action="store_true", help="every day and campaign in gold"
    )
    args = parser.parse_args(argv)
    lake = Lake.from_environment(args.lake_root)
    spark = build_session("inventory-mart-load")
    if args.all:
        load_id = load_mart(spark, lake)
    else:
        load_id = load_mart(
            spark,
            lake,
            business_day(args.summary_date),
            campaign(args.campaign_id),
            business_day(args.recon_date or args.summary_date),
        )
    refresh_views(spark, lake)
    return load_id


if __name__ == "__main__":
    main()
