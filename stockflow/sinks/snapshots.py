"""Partitioned tables that change by whole versions: K9, K10, J6, L1."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from stockflow import schemas
from stockflow.operators.merge import merged
from stockflow.storage import children, drop, partition_dir, rename_new

# Fixed value: the folder Spark gives a partition whose value is NULL.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
KEPT_VERSIONS = 3
Slice = Callable[[DataFrame], DataFrame]


class ConcurrentChange(RuntimeError):
    """Raised when another writer has changed partitions that this one replaces."""


class SnapshotTable:
    """Parquet partitions under a list of partitions that is replaced as a whole.

    Every write puts its rows into a folder of its own; nothing that exists is touched. A
    version lists, for each partition, the folder it lies in and its number of rows. It
    becomes the table by one rename, which fails if another writer was first. Readers take
    the list of one version, so they see all of a write or nothing, and open just the
    folders of the slice they ask for.

    Inside a partition rows are ranged by the sort columns (L1): the files of a partition
    hold ranges that do not overlap, so that a filter on a sort column skips files.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: str,
        partition_cols: list[str],
        sort_cols: list[str] | None = None,
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.partition_cols = partition_cols
        self.sort_cols = [name for name in sort_cols or [] if name not in partition_cols]
        kinds = dict(field.split(None, 1) for field in schema.split(", "))
        self._keys = ", ".join(f"{name} {kinds[name]}" for name in partition_cols)
        self._columns = schemas.column_names(schema)

    def _version_path(self, version: int) -> str:
        return f"{self.path}/versions/{version:012d}"

    def _data(self, write: str) -> str:
        return f"{self.path}/data/write={write}"

    def versions(self) -> list[int]:
        """The versions that can still be read, oldest first."""
        return [int(name) for name in children(self.spark, f"{self.path}/versions/*")]

    def version(self) -> int:
        """The newest version, 0 before the first write."""
        return max(self.versions(), default=0)

    def partitions(self, version: int | None = None) -> DataFrame:
        """The list of a version: partition columns, folder of the write, row count.

        ``upto`` is what the writer noted of its source, the same in all rows.
        """
        version = self.version() if version is None else version
        schema = f"{self._keys}, write STRING, n_rows BIGINT, upto BIGINT"
        if not version:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._version_path(version))

    def upto(self, version: int | None = None) -> int:
        """How far into its source a version reaches; 0 for a table without rows."""
        row = self.partitions(version).select("upto").first()
        return (row and row["upto"]) or 0

    def read(self, version: int | None = None, only: Slice | None = None) -> DataFrame:
        """The rows of one version; ``only`` restricts the list of partitions first."""
        listed = self.partitions(version)
        listed = only(listed) if only else listed
        paths = [self._folder(row) for row in listed.toLocalIterator()]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.option("basePath", f"{self.path}/data")
        rows = rows.schema(f"{self.schema}, write STRING").parquet(*paths)
        return rows.select(*self._columns)

    def _folder(self, row: Row) -> str:
        """Where a listed partition lies."""
        values = {name: row[name] for name in self.partition_cols}
        named = {name: NULL_FOLDER if v in (None, "") else v for name, v in values.items()}
        return partition_dir(self._data(row["write"]), **named)

    def replace(self, rows: DataFrame, emptied: Column | None = None, upto: int = 0) -> int:
        """K9: replace the partitions that occur in ``rows``; returns the new version.

        Partitions that meet ``emptied`` and do not occur in the rows are left out.
        """
        base = self.version()
        return self._commit(base, self._write(rows), emptied, upto)

    def merge(self, source: DataFrame, keys: list[str], upto: int = 0) -> int:
        """Insert source rows, or replace the rows of the same key.

        ``keys`` include the partition columns. Only partitions that the source touches
        are read and written anew.
        """
        base = self.version()
        touched = source.select(*self.partition_cols).distinct()
        current = self.read(base, lambda listed: self._matching(listed, touched, "left_semi"))
        rows = merged(current, source.select(*self._columns), keys)
        return self._commit(base, self._write(rows), upto=upto)

    def _write(self, rows: DataFrame) -> DataFrame:
        """Store rows in a folder of their own and list its partitions.

        The counts come from the files' footers and must add up to what the write saw.
        """
        write, seen = uuid.uuid4().hex, Observation()
        order = [*self.partition_cols, *self.sort_cols]
        (
            rows.repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .observe(seen, F.count(F.lit(1)).alias("n"))
            .write.partitionBy(*self.partition_cols)
            .parquet(self._data(write))
        )
        stored = self.spark.read.schema(self.schema).parquet(self._data(write))
        found = stored.groupBy(*self.partition_cols).agg(F.count("*").alias("n_rows"))
        counted = found.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
        if counted != seen.get["n"]:
            raise RuntimeError(f"{seen.get['n']} rows were written and {counted} are there")
        return found.withColumn("write", F.lit(write))

    def _matching(self, listed: DataFrame, partitions: DataFrame, how: str) -> DataFrame:
        """Partitions of a list that occur in another; empty text is stored as NULL."""

        def value(name: str) -> Column:
            return F.nullif(F.col(name).cast("string"), F.lit(""))

        other = partitions.select(*[value(name).alias(f"_{name}") for name in self.partition_cols])
        same = [value(name).eqNullSafe(F.col(f"_{name}")) for name in self.partition_cols]
        return listed.join(other, same, how)

    def _commit(
        self, base: int, added: DataFrame, emptied: Column | None = None, upto: int = 0
    ) -> int:
        """Make a version of the base and the added partitions the newest one.

        If another version is there already, it becomes the base, unless it has changed a
        partition that this one replaces.
        """
        while True:
            listed = self.partitions(base)
            kept = self._matching(listed, added, "left_anti")
            if emptied is not None:
                kept = kept.filter(~F.coalesce(emptied, F.lit(False)))
            staged = f"{self.path}/staged/{uuid.uuid4().hex}"
            kept = kept.drop("upto").unionByName(added)
            noted = kept.withColumn("upto", F.lit(upto).cast("bigint"))
            noted.coalesce(1).write.parquet(staged)
            if rename_new(self.spark, staged, self._version_path(base + 1)):
                return base + 1
            drop(self.spark, staged)
            newest = self.version()
            changed = self.changes(base, newest)
            mine = self._matching(changed, added, "left_semi")
            if emptied is not None:
                mine = mine.unionByName(changed.filter(emptied))
            if not mine.isEmpty():
                raise ConcurrentChange(f"version {newest} of {self.path} has changed the same partitions")
            base = newest

    def changes(self, old: int, new: int | None = None) -> DataFrame:
        """The partitions that differ between two versions."""
        before, after = self.partitions(old).drop("upto"), self.partitions(new).drop("upto")
        either = after.exceptAll(before).union(before.exceptAll(after))
        return either.select(*self.partition_cols).distinct()

    def vacuum(self, keep: int = KEPT_VERSIONS) -> None:
        """Forget all but the newest versions, and partitions that only those listed."""
        *old, first = self.versions()[: 1 - keep] or [0]
        if not old or keep < 1:
            return
        columns = [*self.partition_cols, "write"]
        kept = [self.partitions(version) for version in self.versions() if version >= first]
        for version in old:
            gone = self.partitions(version).select(*columns)
            for listed in kept:
                gone = gone.exceptAll(listed.select(*columns))
            for row in gone.toLocalIterator():
                drop(self.spark, self._folder(row))
            drop(self.spark, self._version_path(version))
