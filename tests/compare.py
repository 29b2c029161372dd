"""Row-by-row comparison of a Spark result with its SQL twin."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

# The driver's tables.
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def spark_rows(rows) -> Counter:
    names = sorted(rows.columns)
    return Counter(
        tuple(_value(row[name]) for name in names) for row in rows.collect()
    )


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], Counter]:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'"
        )
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    order = sorted(range(len(names)), key=lambda at: names[at])
    rows = Counter(
        tuple(_value(row[at]) for at in order) for row in result.fetchall()
    )
    connection.close()
    return sorted(names), rows


def difference(rows, sf_dir: str, sql: str) -> str | None:
    """What differs, or None when both sides hold the same rows."""
    names, expected = oracle_rows(sf_dir, sql)
    if sorted(rows.columns) != names:
        return f"columns {sorted(rows.columns)} against {names}"
    actual = spark_rows(rows)
    if actual == expected:
        return None
    return (
        f"{sum(actual.values())} against {sum(expected.values())} rows; "
        f"only Spark {list((actual - expected).items())[:2]}; "
        f"only SQL {list((expected - actual).items())[:2]}"
    )
