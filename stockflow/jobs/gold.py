"""Daily gold job: ``python -m stockflow.jobs.gold``, or this file to spark-submit."""

from __future__ import annotations

import argparse

from stockflow.jobs.arguments import business_day, campaign
from stockflow.lake import Lake
from stockflow.plans.gold import run_gold
from stockflow.session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Build the gold tables of a day")
    parser.add_argument("--recon-date")
    parser.add_argument("--campaign-id")
    parser.add_argument("--lake-root")
    parser.add_argument(
        "--all", action="store_true", help="every day and campaign with a snapshot"
    )
    args = parser.parse_args(argv)
    lake = Lake.from_environment(args.lake_root)
    spark = build_session("inventory-gold-batch-job")
    if args.all:
        run_gold(spark, lake)
    else:
        run_gold(
            spark, lake, business_day(args.recon_date), campaign(args.campaign_id)
        )


if __name__ == "__main__":
    main()
