"""Hard negatives by exact inner products, many candidates to one multiplication.

Kronecker packing: a constant is added to a dimension's components in a block, so that
none is negative, and the sums become fields of equal width in one wide integer. The
anchor's component, made non-negative the same way, multiplies that integer once; the
products of all dimensions are added as wide integers. Fields are wide enough for the
largest sum, so none runs over into the next, and each holds one candidate's inner product
plus what the constants brought in, which is known and taken off.
"""

from __future__ import annotations

from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm import vectors as V

ANCHOR = "part int, seq int, at int, id bigint, label bigint, v array<bigint>"


class Packed:
    """The vectors of a block as one wide integer per dimension.

    ``least`` and ``top`` bound the components of the anchors that will be scored.
    """

    def __init__(self, values: np.ndarray, least: int, top: int):
        self.count, width = values.shape
        self.bias = max(0, -int(values.min(initial=0)))
        self.anchor_bias = max(0, -least)
        largest = width * (int(values.max(initial=0)) + self.bias) * (top + self.anchor_bias)
        if largest >= 2**63:
            raise OverflowError("packed products of these components do not fit a field")
        self.kind = "<u4" if largest < 2**32 else "<u8"
        fields = (values + self.bias).astype(self.kind)
        self.wide = [int.from_bytes(fields[:, d].tobytes(), "little") for d in range(width)]
        # What the anchor's constant adds to each field, and one part of the candidates'.
        self.fixed = self.anchor_bias * (values.sum(axis=1) + width * self.bias)

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """The inner product of an anchor with every vector of the block."""
        raised = (anchor + self.anchor_bias).tolist()
        total = sum(map(mul, raised, self.wide))
        data = total.to_bytes(self.count * int(self.kind[2:]), "little")
        fields = np.frombuffer(data, self.kind).astype(np.int64)
        return fields - self.fixed - self.bias * int(anchor.sum())


class Ranked:
    """The first few of the rows seen so far, by score and id."""

    def __init__(self, count: int):
        self.count = count
        self.scores = np.empty(0, np.int64)
        self.no_id = np.empty(0, bool)
        self.ids = np.empty(0, np.int64)

    def merge(self, scores: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> None:
        if len(self.scores) == self.count:
            good = scores >= self.scores[-1]
            scores, no_id, ids = scores[good], no_id[good], ids[good]
        if len(scores) > 4 * self.count:
            good = scores >= np.partition(scores, len(scores) - self.count)[-self.count]
            scores, no_id, ids = scores[good], no_id[good], ids[good]
        if len(scores):
            scores = np.concatenate((self.scores, scores))
            no_id = np.concatenate((self.no_id, no_id))
            ids = np.concatenate((self.ids, ids))
            order = V.best_order(scores, no_id, ids)[: self.count]
            self.scores, self.no_id, self.ids = scores[order], no_id[order], ids[order]


def mine(rows: DataFrame, asks: Column, label: Column, positives: int = 5, negatives: int = 10,
         low: int = 30, high: int = 90, scale: float = 256.0, id_column: str = "vec_id",
         vector_column: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows that ``asks``. An anchor's positives are its best ``positives``
    other rows of the same label; for each of them the best ``negatives`` rows of another
    label count whose score lies between ``low`` and ``high`` percent of the positive's,
    both included (so a positive with a score below zero has none). The score is the inner
    product of the components floor(``scale`` * x), as a long; ties go to the smaller id.

    Rows with a null label, a null vector, or a null, NaN or infinite component take no
    part; shorter vectors are filled up with zeros, empty ones score 0. Rows are told apart
    by their place: repeated rows are candidates, positives and anchors of their own. A null
    id is null in the result and last among ties. With fewer rows than asked for all count,
    an empty table gives no row, and other columns are not read. Products that might not
    fit a long are an error.

    Two passes of cells: the first finds the positives, whose scores then bound the
    negatives of the second.
    """
    clean = rows.select(
        F.col(id_column).alias("id"), label.cast("bigint").alias("label"), asks.alias("asks"),
        V.whole_numbers(F.col(vector_column), scale).alias("v"),
    ).where("label is not null")
    packed = V.blocks(clean, "candidates")
    anchors = packed.where("n_asks > 0").mapInArrow(_anchors, ANCHOR)
    order = Window.partitionBy(*V.PLACE).orderBy(F.desc("score"), F.asc_nulls_last("found"))
    best = (
        V.in_cells(packed, anchors, _positives(positives),
                   "part int, seq int, at int, found bigint, score bigint")
        .withColumn("nth", F.row_number().over(order))
        .where(F.col("nth") <= positives)
        .groupBy(*V.PLACE)
        .agg(F.collect_list(F.struct("nth", F.col("found").alias("id"), "score")).alias("bounds"))
    )
    bounded = anchors.join(best, V.PLACE)
    order = Window.partitionBy(*V.PLACE, "nth").orderBy(
        F.desc("negative_score"), F.asc_nulls_last("negative_id")
    )
    return (
        V.in_cells(packed, bounded, _negatives(negatives, low, high),
                   "part int, seq int, at int, nth int, anchor_id bigint, positive_id bigint, "
                   "positive_score bigint, negative_id bigint, negative_score bigint")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def _anchors(batches):
    """The rows of blocks that ask, one row each."""
    for batch in batches:
        for block in V.table_blocks(pa.Table.from_batches([batch]), 0):
            places = np.flatnonzero(block.asks)
            width = block.values.shape[1]
            steps = np.arange(0, width * (len(places) + 1), width, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(np.full(len(places), x, np.int32)) for x in block.place),
                    pa.array(places.astype(np.int32)),
                    pa.array(block.ids[places], mask=block.no_id[places]),
                    pa.array(block.labels[places]),
                    pa.ListArray.from_arrays(
                        pa.array(steps), pa.array(block.values[places].ravel())
                    ),
                ],
                ["part", "seq", "at", "id", "label", "v"],
            )


def _scored(left: pa.Table, right: pa.Table, asked: list[dict]):
    """(block, number of the anchor, scores, own row or -1) of a cell, block by block."""
    if not asked:
        return
    anchors = V.matrix(right["v"].combine_chunks())
    width = max([anchors.shape[1], *left["width"].to_pylist()])
    anchors = V.widened(anchors, width)
    least, top = int(anchors.min()), int(anchors.max())
    for block in V.table_blocks(left, width):
        packed = Packed(block.values, least, top)
        for at, anchor in enumerate(anchors):
            row = asked[at]
            own = row["at"] if (row["part"], row["seq"]) == block.place else -1
            yield block, at, packed.scores(anchor), own


def _positives(count: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        asked = right.drop_columns(["v"]).to_pylist()
        best = [Ranked(count) for _ in asked]
        for block, at, scores, own in _scored(left, right, asked):
            same = block.labels == asked[at]["label"]
            if own >= 0:
                same[own] = False
            best[at].merge(scores[same], block.no_id[same], block.ids[same])
        found = _columns(best)
        keys = _repeated(asked, best, {name: pa.int32() for name in V.PLACE})
        return pa.table({**keys, "found": found[0], "score": found[1]})

    return search


def _negatives(count: int, low: int, high: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        asked = right.drop_columns(["v"]).to_pylist()
        pairs, ranges = [], []
        for row in asked:
            mine = []
            for bound in row["bounds"]:
                least, most = -(-low * bound["score"] // 100), high * bound["score"] // 100
                if least <= most:
                    mine.append((len(pairs), least, most))
                    pairs.append({
                        **{name: row[name] for name in V.PLACE}, "nth": bound["nth"],
                        "anchor_id": row["id"], "positive_id": bound["id"],
                        "positive_score": bound["score"],
                    })
            ranges.append(mine)
        best = [Ranked(count) for _ in pairs]
        for block, at, scores, _ in _scored(left, right, asked):
            other = block.labels != asked[at]["label"]
            for pair, least, most in ranges[at]:
                good = other & (scores >= least) & (scores <= most)
                best[pair].merge(scores[good], block.no_id[good], block.ids[good])
        found = _columns(best)
        kinds = dict.fromkeys([*V.PLACE, "nth"], pa.int32())
        kinds |= dict.fromkeys(["anchor_id", "positive_id", "positive_score"], pa.int64())
        keys = _repeated(pairs, best, kinds)
        return pa.table({**keys, "negative_id": found[0], "negative_score": found[1]})

    return search


def _columns(best: list[Ranked]) -> tuple[pa.Array, pa.Array]:
    empty = [np.empty(0, np.int64)]
    no_id = np.concatenate([np.empty(0, bool), *(one.no_id for one in best)])
    ids = np.concatenate([*empty, *(one.ids for one in best)])
    return pa.array(ids, mask=no_id), pa.array(
        np.concatenate([*empty, *(one.scores for one in best)])
    )


def _repeated(rows: list[dict], best: list[Ranked], kinds: dict) -> dict[str, pa.Array]:
    """The columns of each row once per result it has."""
    counts = [len(one.ids) for one in best]
    at = pa.array(np.repeat(np.arange(len(rows)), counts))
    return {
        name: pa.array([row[name] for row in rows], kind).take(at) for name, kind in kinds.items()
    }
