"""Reports from the mart's views: ``python -m stockflow.jobs.report``, or to spark-submit."""

from __future__ import annotations

import argparse

from stockflow.lake import Lake
from stockflow.plans.views import VIEWS, create_views
from stockflow.session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Write a view of the mart")
    parser.add_argument("--view", choices=VIEWS, required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--format", choices=["parquet", "csv", "json"], default="parquet")
    parser.add_argument("--lake-root")
    args = parser.parse_args(argv)
    lake = Lake.from_environment(args.lake_root)
    spark = build_session("inventory-report")
    create_views(spark, lake)
    rows = spark.table(args.view).write.mode("overwrite").format(args.format)
    rows.option("header", True).save(args.output)


if __name__ == "__main__":
    main()
