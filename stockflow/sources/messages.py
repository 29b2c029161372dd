"""Message streams: S1, S2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockflow import schemas

# Starting positions and authentication modes.
STARTING_OFFSETS = ["earliest", "latest"]
AUTH_MODES = ["iam", "plaintext"]
DEFAULT_TOPIC = "inventory-events"

# Broker options of the IAM mode.
IAM_OPTIONS = {
    "kafka.security.protocol": "SASL_SSL",
    "kafka.sasl.mechanism": "AWS_MSK_IAM",
    "kafka.sasl.jaas.config": "software.amazon.msk.auth.iam.IAMLoginModule required;",
    "kafka.sasl.client.callback.handler.class":
        "software.amazon.msk.auth.iam.IAMClientCallbackHandler",
}


def auth_options(auth_mode: str) -> dict[str, str]:
    """Broker options for an authentication mode."""
    if auth_mode not in AUTH_MODES:
        raise ValueError(f"auth_mode must be one of {AUTH_MODES}, not {auth_mode!r}")
    return dict(IAM_OPTIONS) if auth_mode == "iam" else {}


def kafka_options(
    servers: str,
    topic: str = DEFAULT_TOPIC,
    starting_offsets: str = "latest",
    auth_mode: str = "iam",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source.

    A bound on the offsets per trigger bounds every group of a micro-batch, also
    while a backlog is worked off.
    """
    if not servers:
        raise ValueError("bootstrap servers are required")
    if starting_offsets not in STARTING_OFFSETS:
        raise ValueError(f"starting_offsets must be one of {STARTING_OFFSETS}")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
        **auth_options(auth_mode),
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_kafka_stream(spark: SparkSession, **settings) -> DataFrame:
    """The topic as a streaming DataFrame. Needs the Kafka connector."""
    return (
        spark.readStream.format("kafka").options(**kafka_options(**settings)).load()
    )


def read_message_files(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """S1 without a broker: Parquet files with the columns of the Kafka source."""
    reader = spark.readStream.schema(schemas.ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
