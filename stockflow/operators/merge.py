"""Keyed merge and duplicate-key guard: K10, A6, J6."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeys(ValueError):
    """Raised before a merge whose source is not unique by key."""


def merged(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows, plus target rows whose key the source does not have.

    Both sides are unique by key, so the anti join has no hot key. Target rows
    that vanished from the source stay.
    """
    return source.unionByName(target.join(source.select(*keys), keys, "left_anti"))


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return (
        rows.groupBy(*keys)
        .agg(F.count("*").alias("duplicate_count"))
        .filter(F.col("duplicate_count") > 1)
    )


def require_unique(rows: DataFrame, keys: list[str], label: str) -> None:
    """Raise with the number of duplicate keys, if there are any."""
    duplicates = duplicate_keys(rows, keys).count()
    if duplicates:
        raise DuplicateKeys(
            f"Duplicate keys in {label}: duplicate_key_count={duplicates}"
        )
