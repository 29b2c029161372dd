"""Exact search by inner product: Fagin's threshold algorithm over sorted lists.

Every block of vectors has, per dimension, its rows in order of that component. A query
reads all lists in parallel, the high end first where its own component is positive and
the low end first where it is negative, and scores each row at its first appearance. No
row that is still unseen can score more than the sum over the dimensions of the query's
component times the last value read. Once the query's k-th best score is above that bound,
the block is done.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm import vectors as V

FIRST_STEP = 16  # rows read from every list before the first look at the bound
_NONE = np.iinfo(np.int64).min


class Lists:
    """The sorted lists of one block."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.order = np.argsort(values, axis=0, kind="stable").T.copy()

    def top(self, query: np.ndarray, best: Best, no_id: np.ndarray, ids: np.ndarray,
            own: int = -1) -> int:
        """Merge the block's rows into the query's best ones; returns the depth read.

        ``own`` is the query's row in this block, which is no candidate.
        """
        high, low = np.flatnonzero(query >= 0), np.flatnonzero(query < 0)
        n, depth, step = len(self.values), 0, FIRST_STEP
        seen = np.zeros(n, bool)
        if own >= 0:
            seen[own] = True
        while depth < n:
            upto = min(n, depth + step)
            read = np.zeros(n, bool)
            read[self.order[high, n - upto : n - depth]] = True
            read[self.order[low, depth:upto]] = True
            new = np.flatnonzero(read & ~seen)
            seen |= read
            best.merge(self.values[new] @ query, no_id[new], ids[new])
            last_high = self.values[self.order[high, n - upto], high]
            last_low = self.values[self.order[low, upto - 1], low]
            bound = int(query[high] @ last_high) + int(query[low] @ last_low)
            depth, step = upto, 2 * step
            # At equality an unseen row may still win by its smaller id.
            if best.floor > bound:
                break
        return depth


class Best:
    """The k best rows of one query so far, and a score below which no row counts."""

    def __init__(self, k: int, floor: int | None = None):
        self.k = k
        self.floor = _NONE if floor is None else floor
        self.scores = np.empty(0, np.int64)
        self.no_id = np.empty(0, bool)
        self.ids = np.empty(0, np.int64)

    def merge(self, scores: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> None:
        good = np.flatnonzero(scores >= self.floor)
        if not len(good):
            return
        if len(good) > 4 * self.k:
            least = np.partition(scores[good], len(good) - self.k)[len(good) - self.k]
            good = good[scores[good] >= least]
        scores = np.concatenate((self.scores, scores[good]))
        no_id = np.concatenate((self.no_id, no_id[good]))
        ids = np.concatenate((self.ids, ids[good]))
        order = V.best_order(scores, no_id, ids)[: self.k]
        self.scores, self.no_id, self.ids = scores[order], no_id[order], ids[order]
        if len(order) == self.k:
            self.floor = max(self.floor, int(self.scores[-1]))


def top_k(rows: DataFrame, asks: Column, k: int = 5, scale: float = 256.0,
          id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): the k best other rows of every row that ``asks``.

    Components are floor(``scale`` * x); the score is the inner product as a long, and
    ties go to the smaller id. Vectors that are null or hold a null, NaN or infinite
    component take no part; a shorter vector is filled up with zeros, an empty one scores
    0 everywhere. Rows are told apart by their place, not their id: a repeated row is a
    candidate of its own and, if it asks, a query of its own. A null id is null in the
    result and last among ties; ``asks`` null means no. Queries with fewer than k other
    rows get all of them, an empty table gives no row, and other columns are not read.
    Products that might not fit a long are an error.

    A query first searches its own block. The k-th score found there is a floor for all
    other blocks, so that their bounds fall below it sooner.
    """
    clean = rows.select(
        F.col(id_column).alias("id"), F.lit(None).cast("bigint").alias("label"),
        asks.alias("asks"), V.whole_numbers(F.col(vector_column), scale).alias("v"),
    )
    packed = V.blocks(clean, "lists")
    queries = packed.where("n_asks > 0").mapInArrow(
        _floors(k), "part int, seq int, at int, id bigint, v array<bigint>, floor bigint"
    )
    found = V.in_cells(
        packed, queries, _search(k),
        "part int, seq int, at int, query_id bigint, id bigint, score bigint",
    )
    order = Window.partitionBy(*V.PLACE).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )


def _floors(k: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in V.table_blocks(pa.Table.from_batches([batch]), 0):
                yield _asked(block, k)

    return ask


def _asked(block: V.Block, k: int) -> pa.RecordBatch:
    lists = Lists(block.values)
    V.require_long(block.values, block.values)
    places = np.flatnonzero(block.asks)
    floors = []
    for at in places:
        best = Best(k)
        lists.top(block.values[at], best, block.no_id, block.ids, at)
        floors.append(best.floor if len(best.ids) == k else None)
    part, seq = block.place
    width = block.values.shape[1]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(places), part, np.int32)),
            pa.array(np.full(len(places), seq, np.int32)),
            pa.array(places.astype(np.int32)),
            pa.array(block.ids[places], mask=block.no_id[places]),
            pa.ListArray.from_arrays(
                pa.array(np.arange(0, width * (len(places) + 1), width, dtype=np.int32)),
                pa.array(block.values[places].ravel()),
            ),
            pa.array(floors, pa.int64()),
        ],
        ["part", "seq", "at", "id", "v", "floor"],
    )


def _search(k: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        asked = right.drop_columns(["v"]).to_pylist()
        queries = V.matrix(right["v"].combine_chunks()) if asked else np.zeros((0, 1), np.int64)
        width = max([queries.shape[1], *left["width"].to_pylist()])
        queries = V.widened(queries, width)
        best = [Best(k, row["floor"]) for row in asked]
        own = [(row["part"], row["seq"]) for row in asked]
        if asked:
            for block in V.table_blocks(left, width):
                V.require_long(block.values, queries)
                lists = Lists(block.values)
                for at, query in enumerate(queries):
                    place = asked[at]["at"] if own[at] == block.place else -1
                    lists.top(query, best[at], block.no_id, block.ids, place)
        return _answers(asked, best)

    return search


def _answers(asked: list[dict], best: list[Best]) -> pa.Table:
    counts = [len(one.ids) for one in best]
    keys = {name: [row[name] for row in asked] for name in (*V.PLACE, "id")}
    kinds = {"part": pa.int32(), "seq": pa.int32(), "at": pa.int32(), "id": pa.int64()}
    repeat = pa.array(np.repeat(np.arange(len(asked)), counts))
    columns = {
        "query_id" if name == "id" else name: pa.array(values, kinds[name]).take(repeat)
        for name, values in keys.items()
    }
    empty = [np.empty(0, np.int64)]
    no_id = np.concatenate([np.empty(0, bool), *(one.no_id for one in best)])
    ids = np.concatenate([*empty, *(one.ids for one in best)])
    columns["id"] = pa.array(ids, mask=no_id)
    columns["score"] = pa.array(np.concatenate([*empty, *(one.scores for one in best)]))
    return pa.table(columns)
