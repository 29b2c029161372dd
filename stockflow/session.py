"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROCKSDB = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Settings the jobs rely on. All can be changed at run time, so they can be
# applied to a session someone else made.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str, **conf: str) -> SparkSession:
    """A session for a job. Sizing is left to the cluster's own settings."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**RUNTIME, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the jobs rely on to an existing session."""
    for name, value in RUNTIME.items():
        spark.conf.set(name, value)
    return spark
