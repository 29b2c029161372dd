"""SimHash near-duplicates, searched with Burkhard-Keller trees.

The trees of all documents would outgrow any broadcast, so they are cut into shards:
two fingerprints within the radius agree on some choice of bit blocks (pigeonhole), and
each agreeing pair meets in the shard of that choice and value. A shard's tree is sent
to the slices of queries that search it, and to nothing else.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm import words as W
from stockflow.llm.graph import components
from stockflow.storage import stored

SEED = 42
# Rows of one tree; a larger shard is cut into trees, and each meets each.
SLICE = 8192
# Searches of a tree that are followed at once, which bounds memory.
FRONTIER = 1 << 20
_CHUNK = 1 << 16
# Rows of whole shards that a task holds at once.
_HELD = 1 << 18


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of the word shingles, repeats included; fewer words are one shingle."""
    parts = text.translate(W.LOWER).split()
    if not parts:
        return np.zeros(0, np.uint64)
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    last = min(size, len(parts)) - 1
    hashed = xxhash.xxh64_intdigest
    return np.array(
        [
            hashed(line[a:b], SEED)
            for a, b in zip(starts.tolist(), (ends[last:] - 1).tolist(), strict=False)
        ],
        np.uint64,
    )


def majority(values: np.ndarray) -> int:
    """The bits set in over half of the values; zero without values."""
    counts = np.zeros(64, np.int64)
    for low in range(0, len(values), _CHUNK):
        part = np.ascontiguousarray(values[low : low + _CHUNK]).astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(values), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, id_column: str, text_column: str,
                 shingle: int = 4, more: int = 0, more_shingle: int = 5) -> DataFrame:
    """(id, fp, wide): the fingerprint, and ``more`` words of one over longer shingles."""
    kind = documents.schema[id_column].dataType.simpleString()
    rows = documents.select(
        F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")
    )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, wides = [], []
            for text in W.texts(batch.column(1)):
                values = shingle_hashes(text, shingle)
                prints.append(majority(values))
                if more:
                    values = shingle_hashes(text, more_shingle)
                wides.append(
                    [
                        majority(W.mix(values + np.uint64(k << 60 | k)))
                        for k in range(1, more + 1)
                    ]
                )
            signed = np.array(prints, np.uint64).view(np.int64)
            wide = np.array(wides, np.uint64).reshape(len(prints), more).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(signed), pa.array(list(wide), pa.list_(pa.int64()))],
                ["id", "fp", "wide"],
            )

    return rows.mapInArrow(compute, f"id {kind}, fp bigint, wide array<bigint>")


def masks(radius: int, agree: int = 1) -> list[int]:
    """Bit masks: any two values within the radius are equal under one of them.

    ``radius + agree`` blocks of bits, at most ``radius`` of which can differ; a mask
    for each choice of ``agree`` blocks.
    """
    edges = np.linspace(0, 64, radius + agree + 1).astype(int)
    blocks = [(1 << int(b)) - (1 << int(a)) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(choice) for choice in combinations(blocks, agree)]


def agreeing(count: int, radius: int) -> int:
    """How many blocks must agree so that so many fingerprints make shards of one tree.

    More blocks mean more copies of each row, but a number of copies that the data cannot
    raise by filling shards: a shard of c trees repeats each row c times.
    """
    agree = 1
    while count >> min(mask.bit_count() for mask in masks(radius, agree)) > SLICE:
        agree += 1
    return agree


def _whole_shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows that are sorted by shard, in tables that cut no shard."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= _HELD:
            table = pa.Table.from_batches(held)
            shard = table["shard"].to_numpy()
            cut = int(np.searchsorted(shard, shard[-1]))
            if cut:
                yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
            size -= cut
    if size:
        yield pa.Table.from_batches(held)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


class Forest:
    """Burkhard-Keller trees of many groups, built and searched level by level.

    A node's children are keyed by their distance to it, at most one for each distance.
    """

    def __init__(self, values: np.ndarray, groups: np.ndarray):
        """``groups`` ascends; the first value of each group is its root."""
        self.values, size = values, len(values)
        first = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]][:size])
        self.root = np.repeat(first, np.diff(np.r_[first, size]))
        key = np.full(size, -1, np.int64)
        todo = np.flatnonzero(self.root != np.arange(size))
        at = self.root[todo]
        while len(todo):
            edge = at * 65 + np.bitwise_count(values[todo] ^ values[at])
            order = np.argsort(edge, kind="stable")
            new = np.r_[True, edge[order][1:] != edge[order][:-1]]
            child = np.repeat(todo[order][new], np.diff(np.r_[np.flatnonzero(new), len(new)]))
            key[todo[order][new]] = edge[order][new]
            todo, at = todo[order][~new], child[~new]
        self.child = np.argsort(key, kind="stable")
        self.key = key[self.child]

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, earlier node) within the radius, for queries given by index."""
        stack = [(queries, self.root[queries])]
        while stack:
            query, node = stack.pop()
            if len(query) > FRONTIER:
                half = len(query) // 2
                stack += [(query[:half], node[:half]), (query[half:], node[half:])]
                continue
            away = np.bitwise_count(self.values[query] ^ self.values[node]).astype(np.int64)
            near = (away <= radius) & (node < query)
            if near.any():
                yield query[near], node[near]
            low = np.searchsorted(self.key, node * 65 + np.maximum(away - radius, 0))
            high = np.searchsorted(self.key, node * 65 + np.minimum(away + radius, 64), "right")
            count = high - low
            if count.any():
                stack.append((np.repeat(query, count), self.child[W.ragged(low, count)]))


def forest_links(values: np.ndarray, groups: np.ndarray, radius: int,
                 wide: np.ndarray | None = None, wide_radius: int = 0,
                 step: int = 4096) -> np.ndarray:
    """For each value the first value of its group that it reaches through links.

    Links stay inside the task: what leaves it is a spanning star of each component,
    so no more than one row per value.
    """
    forest, label = Forest(values, groups), np.arange(len(values))
    for low in range(0, len(values), step):
        queries = np.arange(low, min(low + step, len(values)))
        for query, node in forest.search(queries, radius):
            if wide is not None:
                apart = np.bitwise_count(wide[query] ^ wide[node]).sum(1, dtype=np.int64)
                query, node = query[apart <= wide_radius], node[apart <= wide_radius]
            _join(label, query, node)
    while True:
        up = label[label]
        if (up == label).all():
            return label
        label = up


def _join(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Join the components at both ends of each link, in place."""
    while len(left):
        a, b = label[left], label[right]
        while True:
            up_a, up_b = label[a], label[b]
            if (up_a == a).all() and (up_b == b).all():
                break
            a, b = up_a, up_b
        apart = a != b
        if not apart.any():
            return
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))


def _shards(vertices: DataFrame, radius: int, agree: int) -> DataFrame:
    """Each vertex once for every mask and every tree that it meets."""
    choices = F.array(
        *[
            F.struct(F.lit(at).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("part"))
            for at, mask in enumerate(masks(radius, agree))
        ]
    )
    rows = vertices.select("vertex", "fp", "wide", F.explode(choices).alias("c"))
    rows = rows.select("vertex", "fp", "wide", "c.mask", "c.part")
    # Only shards beyond one tree are listed, so this table is far smaller than rows.
    hot = rows.groupBy("mask", "part").count().where(F.col("count") > SLICE)
    hot = hot.select("mask", "part", F.ceil(F.col("count") / SLICE).cast("int").alias("cuts"))
    rows = rows.join(hot, ["mask", "part"], "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    own = F.pmod(F.xxhash64("vertex", F.lit(7)), F.col("cuts")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("cuts") - 1),
        lambda other: F.least(own, other) * F.col("cuts") + F.greatest(own, other),
    )
    rows = rows.select("vertex", "fp", "wide", "mask", "part", F.explode(pairs).alias("tree"))
    return rows.select("vertex", "fp", "wide", F.xxhash64("mask", "part", "tree").alias("shard"))


def links(vertices: DataFrame, radius: int, agree: int = 1, wide_radius: int = 0) -> DataFrame:
    """Edges (a, b) that connect all vertices (vertex, fp, wide) within the radius.

    With ``wide_radius`` a link also needs that many or fewer differing bits in the
    independent words. A task reads its shards one run after the other.
    """

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_shards(batches):
            vertex = table["vertex"].to_numpy()
            values = table["fp"].to_numpy().view(np.uint64)
            wide = None
            if wide_radius:
                flat = table["wide"].combine_chunks().flatten().to_numpy()
                wide = flat.view(np.uint64).reshape(len(table), -1)
            label = forest_links(values, table["shard"].to_numpy(), radius, wide, wide_radius)
            moved = label != np.arange(len(label))
            yield pa.RecordBatch.from_arrays(
                [pa.array(vertex[moved]), pa.array(vertex[label[moved]])], ["a", "b"]
            )

    rows = _shards(vertices, radius, agree)
    if not wide_radius:
        rows = rows.drop("wide")
    rows = rows.repartition("shard").sortWithinPartitions("shard")
    return rows.mapInArrow(search, "a bigint, b bigint")


def near_duplicates(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    shingle: int = 4, radius: int = 4, agree: int | None = None,
                    more: int = 0, wide_radius: int = 0) -> DataFrame:
    """(id, fp, component): each document's fingerprint and its group.

    Documents link when their fingerprints differ in at most ``radius`` bits (and their
    independent words in ``wide_radius``); a group is what links reach, named by its
    smallest id. Copies share a fingerprint and are searched once. Null and empty texts
    have fingerprint zero and link like others. Rows with a null id are members, but
    name a group only if all of it is null. Repeated rows stay. Other columns are not
    read, so their names cannot clash. An empty table gives no rows. ``agree`` grows with
    the number of distinct fingerprints unless it is given; it changes no result.
    """
    prints = stored(fingerprints(documents, id_column, text_column, shingle, more), "fingerprints")
    vertex = F.xxhash64("fp", "wide") if more else F.col("fp")
    prints = prints.withColumn("vertex", vertex)
    vertices = prints.groupBy("vertex").agg(
        F.min("id").alias("least"), F.first("fp").alias("fp"), F.first("wide").alias("wide")
    )
    vertices = stored(vertices, "vertices")
    agree = agree or agreeing(vertices.count(), radius)
    return named(prints, vertices, components(links(vertices, radius, agree, wide_radius))).select(
        "id", "fp", "component"
    )


def named(prints: DataFrame, vertices: DataFrame, reached: DataFrame) -> DataFrame:
    """The rows of ``prints`` with the least id and the root of what their vertex reaches."""
    rooted = vertices.join(reached, "vertex", "left").select(
        "vertex", "least", F.coalesce("root", "vertex").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return prints.join(rooted.join(names, "root").drop("least"), "vertex")
