"""Rows of an input table whose further columns may have any names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(rows: DataFrame, name: str) -> str:
    """A column name that the rows do not have, in either case."""
    taken = {column.lower() for column in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(*columns: str) -> Column:
    """A digest of some columns' values as text; null is a value of its own."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    return F.unhex(F.sha2(F.concat(*[F.sha2(part(c), 256) for c in columns]), 256))


def without(rows: DataFrame, columns: list[str], lost: DataFrame) -> DataFrame:
    """The rows whose ``row_key`` of the columns is not among those of ``lost`` (one column)."""
    name = fresh(rows, "lost_key")
    return rows.join(lost.toDF(name).distinct(), row_key(*columns) == F.col(name), "left_anti")
