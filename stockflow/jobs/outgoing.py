"""Outgoing records job: ``python -m stockflow.jobs.outgoing``, or this file to spark-submit."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame

from stockflow import schemas
from stockflow.jobs.arguments import campaign
from stockflow.lake import Lake
from stockflow.session import build_session
from stockflow.sinks.records import (
    encode_records,
    outgoing_events,
    write_dead_letters,
    write_to_kafka,
)
from stockflow.sources import messages as M
from stockflow.sources.config import read_promotion_config, require_promotions


def send(
    events: DataFrame,
    promotions: DataFrame,
    lake: Lake,
    records: str | None = None,
    servers: str | None = None,
    topic: str = M.DEFAULT_TOPIC,
    auth_mode: str = "iam",
) -> None:
    """Price events, send those with a whole key, keep the others."""
    priced = outgoing_events(events, promotions)
    if records is not None:
        encode_records(priced).write.mode("append").parquet(records)
    else:
        write_to_kafka(priced, servers, topic, auth_mode)
    write_dead_letters(priced, lake.failed_records)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Send events from files")
    parser.add_argument("--campaign-id")
    parser.add_argument("--events", required=True, help="JSON lines of events")
    parser.add_argument("--promotion-config", required=True)
    parser.add_argument("--records", help="write records here instead of to a broker")
    parser.add_argument(
        "--bootstrap-servers", default=os.getenv("KAFKA_BOOTSTRAP_SERVERS")
    )
    parser.add_argument("--topic", default=os.getenv("KAFKA_TOPIC", M.DEFAULT_TOPIC))
    parser.add_argument(
        "--auth-mode", choices=M.AUTH_MODES, default=os.getenv("MSK_AUTH_MODE", "iam")
    )
    parser.add_argument("--lake-root")
    args = parser.parse_args(argv)
    if not (args.records or args.bootstrap_servers):
        raise ValueError("--records or --bootstrap-servers is required")
    lake = Lake.from_environment(args.lake_root)
    campaign_id = campaign(args.campaign_id)
    spark = build_session("inventory-outgoing")
    promotions = require_promotions(
        read_promotion_config(spark, args.promotion_config, campaign_id),
        args.promotion_config,
    )
    send(
        spark.read.schema(schemas.EVENT).json(args.events),
        promotions,
        lake,
        args.records,
        args.bootstrap_servers,
        args.topic,
        args.auth_mode,
    )


if __name__ == "__main__":
    main()
