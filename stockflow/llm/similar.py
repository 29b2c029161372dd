"""Near-duplicates by exact similarity: SimHash proposes, five-word shingles decide.

Two documents link if and only if their sets of five-word shingles have a Jaccard
similarity of ``SIMILARITY`` or more, and a group is what links reach. Three rounds find
the links; each compares what the rounds before have not brought into one group:

1. fingerprints within the radius, found by Burkhard-Keller trees, each text against the
   first one its fingerprint reaches;
2. texts that share a frequent shingle or one of their first, each against its neighbours
   by size and, for the first shingles, in an order that every shingle deals anew;
3. all texts that share a shingle early enough in a fixed order.

The third alone would lose no link. The first two gather large groups of copies with work
in proportion to their rows, so that the third has no such group to enumerate.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm import words as W
from stockflow.llm.decontaminate import shingles
from stockflow.llm.graph import components
from stockflow.llm.rows import fresh
from stockflow.llm.simhash_dedup import SEED, links, majority, named
from stockflow.storage import discard, stored

SIMILARITY = 0.8
# Frequent shingles that are told apart, and the rows that make one frequent: rows of all
# texts if its hash is divisible by COUNTED, else of a batch.
FREQUENT = 1 << 18
FREQUENT_ROWS = 8
COUNTED = 4
# Rows of one shingle that a task compares together; more are cut into slices.
SLICE_ROWS = 4096
# First shingles of a text, and frequent ones among its early ones, by which it meets
# neighbours before it meets all others, and how many neighbours by each.
EARLY = 8
NEIGHBOURS = 8
# Links of one text that a task checks together.
HUB_LINKS = 4096
# Rows of cells that a task holds together, if a cell has no more.
RUN_ROWS = 1 << 17
_CELLS = 1 << 22
_FOUND = 1 << 20
_CLASSES = 256
# Words of 64 bits in the parity sketch of a text's shingles.
_ODD = ("odd0", "odd1", "odd2", "odd3")


def shingle_set(text: bytes) -> np.ndarray:
    """The distinct five-word shingles, as ascending hashes."""
    data, _ = W.joined([text])
    return np.unique(shingles(W.hashes(data, *W.spans(data))))


def _vertex(values: np.ndarray) -> int:
    """Texts of equal shingles are one vertex."""
    return _signed(xxhash.xxh64_intdigest(values.tobytes(), SEED))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _texts(documents: DataFrame, text_column: str) -> DataFrame:
    return documents.select(F.col(text_column).cast("string").alias("text"))


def content_key(text: Column) -> Column:
    """Tells rows of one id apart by their text."""
    return F.xxhash64(text.cast("string"))


def _profiles(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, key, vertex, fp, n, classes): what is known of every document.

    ``classes`` counts the shingles by the first byte of their hash. Two texts share at
    most the sum of the smaller counts, which rules most pairs out.
    """
    kind = documents.schema[id_column].dataType.simpleString()
    text = F.col(text_column)
    rows = documents.select(
        F.col(id_column).alias("id"), content_key(text).alias("key"),
        text.cast("string").alias("text"),
    )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vertex, prints, sizes, classes = [], [], [], []
            for text in W.texts(batch.column(2)):
                values = shingle_set(text)
                vertex.append(_vertex(values))
                prints.append(_signed(majority(values)))
                sizes.append(len(values))
                counts = np.bincount((values >> np.uint64(56)).astype(np.int64), minlength=_CLASSES)
                classes.append(np.minimum(counts, 65535).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(vertex, pa.int64()), pa.array(prints, pa.int64()),
                 pa.array(sizes, pa.int32()), pa.array(classes, pa.binary())],
                ["id", "key", "vertex", "fp", "n", "classes"],
            )

    return rows.mapInArrow(
        compute, f"id {kind}, key bigint, vertex bigint, fp bigint, n int, classes binary"
    )


def _frequent(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many documents have, ascending, and in about how many they are.

    At most ``FREQUENT`` of them reach the driver. They only order shingles and cut hot
    ones into slices: any order gives the same pairs, and one with frequent shingles
    last compares the fewest. One shingle in ``COUNTED`` is counted over all texts, so
    that a passage which few texts of each batch share is found too; of the others those
    that a batch has often are.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [shingle_set(text) for text in W.texts(batch.column(0))]
            found, times = np.unique(
                np.concatenate([*values, np.zeros(0, np.uint64)]), return_counts=True
            )
            many = (found % np.uint64(COUNTED) == 0) | (times >= FREQUENT_ROWS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[many].view(np.int64)), pa.array(times[many])], ["s", "n"]
            )

    rows = texts.mapInArrow(count, "s bigint, n bigint").groupBy("s").agg(F.sum("n").alias("n"))
    rows = rows.where(F.col("n") >= FREQUENT_ROWS).orderBy(F.desc("n"), "s").limit(FREQUENT).toArrow()
    keys, times = rows["s"].to_numpy().view(np.uint64), rows["n"].to_numpy()
    order = np.argsort(keys)
    return keys[order], times[order]


def _least_shared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Shared shingles that two sizes need for the similarity."""
    return SIMILARITY * (left + right) / (1 + SIMILARITY) - 1e-9


def _odd(values: np.ndarray) -> np.ndarray:
    """For each of 256 classes of shingles, whether their number is odd.

    Two sketches differ in no more bits than the sets in shingles, whatever the sizes.
    """
    kind = ((values >> np.uint64(20)) & np.uint64(64 * len(_ODD) - 1)).astype(np.int64)
    bits = np.bincount(kind, minlength=64 * len(_ODD)) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _prefixes(texts: DataFrame, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(vertex, n, odd, shingles, slices, early): the shingles one of which similar texts share.

    Of n shingles in a fixed order, the first n - ceil(0.8 n) + 1: two texts that share
    none of these share less than 0.8 of the larger one. Those known to be rare come
    first, then those not counted, frequent ones last. ``slices`` has for each how many
    slices its rows are cut into, and 0 where it is not frequent; ``early`` tells the first
    ones and the least hashes of frequent ones, which near copies have in common.
    """
    shared = texts.sparkSession.sparkContext.broadcast(frequent)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (keys, times), seen = shared.value, set()
        for batch in batches:
            vertices, sizes, odd, parts, cuts, early = [], [], [], [], [], []
            for text in W.texts(batch.column(0)):
                values = shingle_set(text)
                vertex = _vertex(values)
                if vertex in seen or not len(values):
                    continue
                seen.add(vertex)
                often = np.zeros(len(values), np.int64)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
                    often = np.where(keys[at] == values, times[at], 0)
                size = len(values) - int(np.ceil(SIMILARITY * len(values) - 1e-9)) + 1
                order = np.lexsort((values, values % np.uint64(COUNTED) != 0, often))[:size]
                hot = np.flatnonzero(often[order])
                meets = np.arange(size) < EARLY
                meets[hot[np.argsort(values[order][hot])[:EARLY]]] = True
                vertices.append(vertex)
                sizes.append(len(values))
                odd.append(_odd(values))
                parts.append(values[order].view(np.int64))
                cuts.append(-(-often[order] // SLICE_ROWS))
                early.append(meets)
            ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(vertices, pa.int64()),
                    pa.array(sizes, pa.int32()),
                    *map(pa.array, np.array(odd, np.int64).reshape(-1, len(_ODD)).T),
                    *(
                        pa.ListArray.from_arrays(
                            pa.array(ends), pa.array(np.concatenate([np.empty(0, kind), *lists]).astype(kind))
                        )
                        for lists, kind in ((parts, np.int64), (cuts, np.int32), (early, bool))
                    ),
                ],
                ["vertex", "n", *_ODD, "shingles", "slices", "early"],
            )

    odd_words = ", ".join(f"{name} bigint" for name in _ODD)
    return texts.mapInArrow(
        compute,
        f"vertex bigint, n int, {odd_words}, shingles array<bigint>, slices array<int>, early array<boolean>",
    )


def _buckets(prefixes: DataFrame, groups: DataFrame, every: bool) -> DataFrame:
    """The rows of each shingle, dealt to tasks; a hot shingle's rows in bounded cells.

    For ``every`` pair, a row meets its own slice and each of the others, so it is sent
    as often as there are slices; else it meets its own only, and frequent and early
    shingles are all that count.
    """
    rows = (
        prefixes.join(groups.toDF("vertex", "group"), "vertex", "left")
        .select(
            "vertex", "n", *_ODD, F.coalesce("group", "vertex").alias("group"),
            F.posexplode(F.arrays_zip("shingles", "slices", "early")).alias("place", "one"),
        )
        .select("one.shingles", "vertex", "n", *_ODD, "place", "group", "one.slices", "one.early")
        .withColumnRenamed("shingles", "shingle")
    )
    if not every:
        rows = rows.where("slices > 0 or early")
    rows = rows.withColumn("slices", F.greatest("slices", F.lit(1)))
    own = F.pmod(F.xxhash64("vertex"), F.col("slices")).cast("int")
    others = F.sequence(F.lit(0), F.col("slices") - 1) if every else F.array(own)
    rows = rows.select("*", own.alias("slice"), F.explode(others).alias("other"))
    columns = ["shingle", "vertex", "n", *_ODD, "place", "group", "slice"] + ["early"] * (not every)
    least, most = F.least("slice", "other"), F.greatest("slice", "other")
    rows = rows.select(*columns, (least * F.col("slices") + most).alias("cell"))
    return rows.repartition("shingle", "cell").sortWithinPartitions("shingle", "cell")


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted rows in whole cells, about ``RUN_ROWS`` at a time."""
    held: list[pa.RecordBatch] = []
    rows, most = 0, RUN_ROWS
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows < most:
            continue
        table = pa.Table.from_batches(held)
        shingle, cell = table["shingle"].to_numpy(), table["cell"].to_numpy()
        other = np.flatnonzero((shingle != shingle[-1]) | (cell != cell[-1]))
        low = other[-1] + 1 if len(other) else 0
        if low:
            yield table.slice(0, low)
        held, rows = table.slice(low).to_batches(), rows - low
        most = max(RUN_ROWS, 2 * rows)
    if rows:
        yield pa.Table.from_batches(held)


def _sharing(every: bool):
    """Pairs (a, b) of unlike groups that share a shingle early enough to be similar.

    Pairs whose sketches differ in more bits than similar sets in shingles are no pairs.
    """

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            yield from within(table)

    def within(table: pa.Table) -> Iterator[pa.RecordBatch]:
        names = ["shingle", "cell", "vertex", "n", "place", "group", "slice", *_ODD]
        names += ["early"] * (not every)
        rows = {name: table[name].to_numpy() for name in names}
        order = np.lexsort((rows["vertex"], rows["n"], rows["cell"], rows["shingle"]))
        rows = {name: rows[name][order] for name in names}
        # Copies that several tasks have read are one vertex, so one row.
        new = np.ones(len(order), bool)
        new[1:] = np.any([rows[name][1:] != rows[name][:-1] for name in ("shingle", "cell", "vertex")], axis=0)
        rows = {name: rows[name][new] for name in names}
        key, cell, vertex, size, place, group, slice_ = (rows[name] for name in names[:7])
        odd = [rows[name] for name in _ODD]
        # A cell of two slices holds the pairs between them, one of a slice those inside.
        new = np.r_[True, (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])]
        first = np.flatnonzero(new)
        mixed = np.minimum.reduceat(slice_, first) != np.maximum.reduceat(slice_, first)
        bucket = np.cumsum(new) - 1

        def possible(at: np.ndarray, other: np.ndarray) -> np.ndarray:
            most = np.minimum(size[at] - place[at], size[other] - place[other])
            fits = (most >= _least_shared(size[at], size[other])) & (group[at] != group[other])
            fits &= ~mixed[bucket[at]] | (slice_[at] != slice_[other])
            x, y = at[fits], other[fits]
            apart = sum(np.bitwise_count((w[x] ^ w[y]).view(np.uint64)).astype(np.int64) for w in odd)
            same = apart <= size[x] + size[y] - 2 * _least_shared(size[x], size[y])
            a, b = vertex[x[same]], vertex[y[same]]
            return np.stack([np.minimum(a, b), np.maximum(a, b)], 1)

        at, step, found = np.arange(len(key)), 1, [np.zeros((0, 2), np.int64)]
        held = 0
        while len(at):
            at = at[at + step < len(key)]
            other = at + step
            # Sizes ascend, so a row with too large a partner has none further on.
            alive = (bucket[at] == bucket[other]) & (size[at] >= SIMILARITY * size[other] - 1e-9)
            at, other = at[alive], other[alive]
            found.append(possible(at, other))
            held += len(found[-1])
            if held > _FOUND:
                yield _pairs(found)
                found, held = [np.zeros((0, 2), np.int64)], 0
            if not every:
                break
            step += 1
        if not every:
            # Neighbours by size are the same for each shingle that two texts share; here they differ.
            early = np.flatnonzero(rows["early"])
            band = np.floor(np.log(size[early]) / -np.log(SIMILARITY))
            dealt = W.mix((vertex[early] ^ key[early]).view(np.uint64))
            early = early[np.lexsort((dealt, band, bucket[early]))]
            for step in range(1, NEIGHBOURS + 1):
                at, other = early[:-step], early[step:]
                alive = bucket[at] == bucket[other]
                found.append(possible(at[alive], other[alive]))
        yield _pairs(found)

    return search


def _pairs(found: list[np.ndarray]) -> pa.RecordBatch:
    pairs = np.unique(np.concatenate(found), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _possible(pairs: DataFrame, vertices: DataFrame) -> DataFrame:
    """The pairs that may be similar by the counts of their shingles' classes."""
    known = vertices.select("vertex", "n", "classes")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (
                np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u2").reshape(-1, _CLASSES)
                for k in (3, 5)
            )
            most = np.minimum(x, y).sum(1, dtype=np.int64)
            need = _least_shared(batch.column(2).to_numpy(), batch.column(4).to_numpy())
            # A count at its limit says nothing.
            good = (most >= need) | (np.minimum(x, y) == 65535).any(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).filter(pa.array(good)) for k in (0, 1)], ["a", "b"]
            )

    both = pairs.join(known.toDF("a", "n_a", "x"), "a").join(known.toDF("b", "n_b", "y"), "b")
    return both.select("a", "b", "n_a", "x", "n_b", "y").mapInArrow(check, "a bigint, b bigint")


def _verified(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The stored pairs (a, b) of vertices whose exact similarity is high enough.

    Each set of shingles is shipped to the first vertex of its pairs; the pairs of a vertex
    with very many are checked in several places.
    """
    cell = lambda name: F.pmod(F.col(name), F.lit(_CELLS)).cast("int").alias("cell")
    cells = pairs.select(cell("a")).union(pairs.select(cell("b"))).distinct().toArrow()
    touched = np.zeros(_CELLS, bool)
    touched[cells["cell"].to_numpy()] = True
    # Only texts of a pair are shipped; the mask has a fixed size.
    shared = texts.sparkSession.sparkContext.broadcast(np.packbits(touched))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask, seen = np.unpackbits(shared.value), set()
        for batch in batches:
            kept = []
            for text in W.texts(batch.column(0)):
                values = shingle_set(text)
                vertex = _vertex(values)
                if mask[vertex % _CELLS] and vertex not in seen:
                    seen.add(vertex)
                    kept.append((vertex, values.tobytes()))
            if kept:
                vertex, values = zip(*kept, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(vertex, pa.int64()), pa.array(values, pa.binary())], ["vertex", "values"]
                )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, hub = None, None
        for batch in batches:
            good = []
            for a, cut, own, _, values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                values = np.frombuffer(values, np.uint64)
                if own:
                    place, hub = (a, cut), values
                    good.append(False)
                    continue
                assert place == (a, cut)
                same = len(np.intersect1d(hub, values, assume_unique=True))
                good.append(same >= _least_shared(len(hub), len(values)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).filter(pa.array(good, pa.bool_())) for k in (0, 3)], ["a", "b"]
            )

    cuts = pairs.groupBy("a").agg(F.ceil(F.count("*") / HUB_LINKS).cast("int").alias("cuts"))
    cut = F.pmod(F.xxhash64("b"), F.col("cuts")).cast("int").alias("cut")
    cutting = pairs.join(cuts, "a").select("a", cut, F.lit(0).alias("own"), F.col("b").alias("vertex"))
    hubs = cutting.select("a", "cut").distinct()
    hubs = hubs.select("a", "cut", F.lit(1).alias("own"), F.col("a").alias("vertex"))
    held = texts.mapInArrow(sets, "vertex bigint, values binary")
    held = held.groupBy("vertex").agg(F.first("values").alias("values"))
    sent = cutting.union(hubs).join(held, "vertex").select("a", "cut", "own", "vertex", "values")
    sent = sent.repartition("a", "cut").sortWithinPartitions("a", "cut", F.desc("own"))
    return stored(sent.mapInArrow(check, "a bigint, b bigint"), "links")


def similar_groups(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                   radius: int = 4, agree: int = 1) -> DataFrame:
    """(id, key, fp, component, root): each row's group, named by its smallest id.

    Rows with a null id are members, but name a group only if all of it is null; ``root``
    tells such groups apart, and ``key`` rows of one id. Null and empty texts have no
    shingles and are alike, and like no other text. Texts of fewer than five words are one
    shingle. Copies are one vertex. Other columns are not read. An empty table gives no
    rows. What is stored on the way is deleted when it has been used.
    """
    texts = _texts(documents, text_column)
    prints = stored(_profiles(documents, id_column, text_column), "fingerprints")
    vertices = prints.groupBy("vertex").agg(
        F.min("id").alias("least"), F.first("fp").alias("fp"), F.first("n").alias("n"),
        F.first("classes").alias("classes"),
    )
    vertices = stored(vertices.withColumn("wide", F.array().cast("array<bigint>")), "vertices")
    near = components(links(vertices.select("vertex", "fp", "wide"), radius, agree)).toDF("a", "b")
    near = stored(_possible(near, vertices), "pairs")
    close = [_verified(texts, near)]
    discard(near)
    prefixes = stored(_prefixes(texts, _frequent(texts)), "prefixes")
    for every in (False, True):
        rows = _buckets(prefixes, components(_all(close)), every)
        pairs = rows.mapInArrow(_sharing(every), "a bigint, b bigint").distinct()
        pairs = stored(_possible(pairs, vertices), "pairs")
        close.append(_verified(texts, pairs))
        discard(pairs)
    discard(prefixes)
    kept = vertices.select("vertex", "least")
    return named(prints, kept, components(_all(close))).select(
        "id", "key", "fp", "component", "root"
    )


def _all(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole


def keep_one(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text",
             radius: int = 4, agree: int = 1) -> DataFrame:
    """The documents with one row of each group left, columns unchanged.

    Groups are those of ``similar_groups``. The row with the smallest id stays, a null id
    being the largest; rows of one id are told apart by their texts, and of rows that
    repeat id and text one stays.
    """
    found = similar_groups(documents, id_column, text_column, radius, agree)
    row = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    found = stored(found.select("root", row.alias("row")), "groups")
    kept = found.groupBy("root").agg(F.min("row").alias("least"))
    lost = found.join(kept, "root").where(F.col("row") > F.col("least"))
    rows = _except(documents, lost.select("row.id", "row.key").distinct(), id_column, text_column)
    again = found.groupBy("row").count().where("count > 1").select("row.id", "row.key")
    if again.isEmpty():
        return rows
    alone = _except(rows, again, id_column, text_column)
    repeated = _except(rows, again, id_column, text_column, "left_semi")
    return alone.unionByName(repeated.dropDuplicates([id_column, text_column]))


def _except(documents: DataFrame, named_rows: DataFrame, id_column: str, text_column: str,
            how: str = "left_anti") -> DataFrame:
    """The documents without, or only, the rows named by id and text."""
    own_id, own_key = fresh(documents, "row_id"), fresh(documents, "row_key")
    same = F.col(id_column).eqNullSafe(F.col(own_id))
    same &= content_key(F.col(text_column)) == F.col(own_key)
    return documents.join(named_rows.toDF(own_id, own_key), same, how)
