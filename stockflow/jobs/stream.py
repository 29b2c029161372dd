"""Streaming job: ``python -m stockflow.jobs.stream``, or this file to spark-submit."""

from __future__ import annotations

import argparse
import os
from datetime import timedelta

from stockflow.lake import Lake
from stockflow.session import build_session
from stockflow.sources import messages as M
from stockflow.streaming.runner import await_any, start_all
from stockflow.streaming.sinks import StateSink


def parse_arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Run the inventory streams")
    parser.add_argument(
        "--bootstrap-servers", default=os.getenv("KAFKA_BOOTSTRAP_SERVERS")
    )
    parser.add_argument("--topic", default=os.getenv("KAFKA_TOPIC", M.DEFAULT_TOPIC))
    parser.add_argument(
        "--auth-mode",
        choices=M.AUTH_MODES,
        default=os.getenv("MSK_AUTH_MODE", "iam"),
    )
    parser.add_argument(
        "--starting-offsets",
        choices=M.STARTING_OFFSETS,
        default=os.getenv("KAFKA_STARTING_OFFSETS", "latest"),
    )
    parser.add_argument(
        "--max-offsets-per-trigger",
        type=int,
        default=20_000_000,
        help="bounds every micro-batch",
    )
    parser.add_argument(
        "--max-files-per-trigger",
        type=int,
        default=1000,
        help="the same bound when message files are read",
    )
    parser.add_argument(
        "--state-partitions",
        type=int,
        help="partitions of the streams' state, kept for the life of a checkpoint",
    )
    parser.add_argument(
        "--dedupe-horizon-hours",
        type=float,
        help="how long consumed event ids are remembered, in message time; else for good",
    )
    parser.add_argument("--lake-root")
    parser.add_argument("--checkpoint-root")
    parser.add_argument(
        "--message-files", help="read message files from here instead of a broker"
    )
    args, _ = parser.parse_known_args(argv)
    if not (args.bootstrap_servers or args.message_files):
        raise ValueError("--bootstrap-servers or KAFKA_BOOTSTRAP_SERVERS is required")
    return args


def main(argv: list[str] | None = None) -> None:
    args = parse_arguments(argv)
    lake = Lake.from_environment(args.lake_root, args.checkpoint_root)
    spark = build_session("inventory-streaming-job")
    if args.message_files:
        messages = M.read_message_files(
            spark, args.message_files, args.max_files_per_trigger
        )
    else:
        messages = M.read_kafka_stream(
            spark,
            servers=args.bootstrap_servers,
            topic=args.topic,
            starting_offsets=args.starting_offsets,
            auth_mode=args.auth_mode,
            max_offsets_per_trigger=args.max_offsets_per_trigger,
        )
    hours = args.dedupe_horizon_hours
    horizon = None if hours is None else timedelta(hours=hours)
    sink = StateSink(spark, lake, dedupe_horizon=horizon)
    queries = start_all(messages, sink, partitions=args.state_partitions)
    await_any(spark, queries)


if __name__ == "__main__":
    main()
