"""Whole-number vectors in blocks of rows, and searches of stated rows against all.

A block is one row of a stored table: the ids, marks and labels of at most ``BLOCK``
vectors and their components as one matrix. The place of a vector (part, seq, at) tells
rows apart whatever their ids are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.storage import stored

BLOCK = 4096  # vectors
# Largest cell of a search: rows against queries that one task holds together.
CELL_ROWS = 262_144
CELL_QUERIES = 65_536
TASKS_PER_CORE = 4

PLACE = ["part", "seq", "at"]
_LIMIT = 2**63


def whole_numbers(vector: Column, scale: float) -> Column:
    """floor(scale * x) of every component, as a long; null where the vector is unusable.

    Unusable are a null vector and one with a null, NaN or infinite component.
    """
    usable = F.forall(
        vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False))
    )
    whole = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    return F.when(usable, whole)


def matrix(vectors: pa.ListArray) -> np.ndarray:
    """Lists as rows of a matrix; shorter ones are filled up with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy()).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(1, int(sizes.max(initial=0)))
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def widened(values: np.ndarray, width: int) -> np.ndarray:
    """The matrix with zero columns up to a width."""
    return np.pad(values, ((0, 0), (0, width - values.shape[1])))


def _packed(values: np.ndarray) -> tuple[str, bytes]:
    top = max(-int(values.min()), int(values.max())) if values.size else 0
    kind = "<i2" if top < 2**15 else "<i4" if top < 2**31 else "<i8"
    return kind, values.astype(kind).tobytes()


def require_long(left: np.ndarray, right: np.ndarray) -> None:
    """Raise if an inner product of rows of both might not fit a long."""
    a, b = (max(-int(x.min()), int(x.max())) if x.size else 0 for x in (left, right))
    if a * b * left.shape[1] >= _LIMIT:
        raise OverflowError("inner products of these components do not fit a long")


def blocks(rows: DataFrame, name: str) -> DataFrame:
    """Store rows (id, label, asks, v) as blocks: their columns as arrays, a matrix.

    Tasks read whole input splits in order and nothing is shuffled; small splits are
    read together.
    """
    spark = rows.sparkSession
    schema = (
        "part int, seq int, size int, n_asks int, ids array<bigint>, labels array<bigint>, "
        "asks array<boolean>, width int, kind string, data binary"
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, count = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            while batch.num_rows:
                taken = batch.slice(0, BLOCK - count)
                batch = batch.slice(taken.num_rows)
                held.append(taken)
                count += taken.num_rows
                if count == BLOCK:
                    yield _block(part, seq, held)
                    seq, held, count = seq + 1, [], 0
        if held:
            yield _block(part, seq, held)

    rows = rows.select(
        F.col("id").cast("bigint").alias("id"), F.col("label").cast("bigint").alias("label"),
        F.coalesce("asks", F.lit(False)).alias("asks"), "v",
    )
    least = spark.sparkContext.defaultParallelism
    few = max(least, ceil(rows.count() / BLOCK))
    return stored(rows.where("v is not null").coalesce(few).mapInArrow(pack, schema), name)


def _block(part: int, seq: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(held).combine_chunks()
    ids, labels, asks, vectors = (column.combine_chunks() for column in table.columns)
    values = matrix(vectors)
    kind, data = _packed(values)

    def one(column: pa.Array) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)

    return pa.RecordBatch.from_arrays(
        [
            *(pa.array([x], pa.int32()) for x in (part, seq, len(ids), asks.true_count)),
            one(ids),
            one(labels),
            one(asks),
            pa.array([values.shape[1]], pa.int32()),
            pa.array([kind]),
            pa.array([data], pa.binary()),
        ],
        ["part", "seq", "size", "n_asks", "ids", "labels", "asks", "width", "kind", "data"],
    )


class Block:
    """One stored block in a task: ids and labels as longs, with marks where they are null."""

    def __init__(self, row: dict, width: int = 0):
        self.place = (row["part"], row["seq"])
        self.ids, self.no_id = _longs(row["ids"])
        self.labels, self.no_label = _longs(row["labels"])
        self.asks = np.array(row["asks"], bool)
        values = np.frombuffer(row["data"], row["kind"]).reshape(row["size"], row["width"])
        self.values = widened(values.astype(np.int64), max(width, row["width"]))


def _longs(values: list) -> tuple[np.ndarray, np.ndarray]:
    none = np.array([x is None for x in values], bool)
    return np.array([0 if x is None else x for x in values], np.int64), none


def table_blocks(table: pa.Table, width: int) -> Iterator[Block]:
    """The blocks of a cell, one at a time."""
    for batch in table.to_batches(max_chunksize=1):
        for row in batch.to_pylist():
            yield Block(row, width)


def in_cells(packed: DataFrame, queries: DataFrame, search: Callable, schema: str,
             cell_rows: int = CELL_ROWS, cell_queries: int = CELL_QUERIES) -> DataFrame:
    """Every query against every block, cell by cell.

    Blocks are dealt to rows and queries to columns of a grid, and ``search`` gets the
    blocks and queries of one cell as Arrow tables. Cells are as large as memory allows,
    since a block travels once per column and a query once per row of the grid, and
    smaller only while there are too few of them for the cores. A cell's size is bounded
    whatever the ids, labels and vectors are, so no key is hot.
    """
    counts = packed.agg(F.count("*"), F.sum("size"), F.sum("n_asks")).first()
    n_blocks, size, asks = (int(x or 0) for x in counts)
    wanted = TASKS_PER_CORE * packed.sparkSession.sparkContext.defaultParallelism
    columns = max(1, ceil(asks / cell_queries))
    rows = max(1, ceil(size / cell_rows), min(n_blocks, ceil(wanted / columns)))

    def dealt(table: DataFrame, own: str, own_count: int, other: str, count: int, key) -> DataFrame:
        return table.select(
            F.pmod(key, F.lit(own_count)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(other),
            *table.columns,
        )

    left = dealt(packed, "_row", rows, "_column", columns, F.col("part") + F.col("seq"))
    right = dealt(queries, "_column", columns, "_row", rows, F.xxhash64(*PLACE))
    cell = ["_row", "_column"]
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(search, schema)


def best_order(scores: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Places by falling score, then rising id, null ids last."""
    return np.lexsort((ids, no_id, -scores))
