"""Benchmark items found in documents: fingerprints of item-sized windows, verification.

A window's fingerprint is the SimHash of its shingles, each with the number of its
occurrence in the window. Weighted similarity is the plain similarity of such numbered
shingles, so the distance of two fingerprints follows it even where shingles repeat.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm import words as W
from stockflow.llm.rows import fresh, row_key, without

SHINGLE = 5
SIMILARITY = 0.8
# Bits of a fingerprint. At similarity 0.8 a bit differs with a chance of 0.155 or less, which
# makes 40 of 256, and over RADIUS with a chance of 3e-14. Unlike texts are 128 apart.
BITS = 256
RADIUS = 88
# Shingles whose bits are unpacked at once, and window and item pairs that are marked at once.
_CHUNK = 1 << 14
_CELLS = 1 << 20
# Bytes of benchmark text that one scan carries; larger benchmarks take several scans.
BLOCK_BYTES = 16 << 20
_FACTORS = W.mix(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(hashed: np.ndarray) -> np.ndarray:
    """Hashes of the word shingles, from the words' hashes; few words are one shingle."""
    size = min(SHINGLE, len(hashed))
    if not size:
        return np.zeros(0, np.uint64)
    count = len(hashed) - size + 1
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total += hashed[k : k + count] * _FACTORS[k]
    return W.mix(total + np.uint64(size))


def _bits(values: np.ndarray) -> np.ndarray:
    """The bits of each value's independent words, one row of ``BITS`` for a value."""
    words = [W.mix(values + np.uint64(k << 60 | k)) for k in range(BITS // 64)]
    part = np.stack(words, axis=1).astype("<u8")
    return np.unpackbits(part.view(np.uint8), axis=1, bitorder="little")


def _packed(ones: np.ndarray) -> np.ndarray:
    return np.packbits(ones, axis=1, bitorder="little").view("<u8")


def _numbered(rows: np.ndarray) -> np.ndarray:
    """Each row sorted, its n-th copy of a shingle made a value of its own."""
    rows = np.sort(rows, axis=1)
    new = np.ones(rows.shape, bool)
    new[:, 1:] = rows[:, 1:] != rows[:, :-1]
    place = np.arange(rows.shape[1])
    copy = place - np.maximum.accumulate(np.where(new, place, 0), axis=1)
    return np.where(copy > 0, W.mix(rows + W.mix(copy.astype(np.uint64))), rows)


def repeating(values: np.ndarray, length: int) -> np.ndarray:
    """For each start, whether a window of that many shingles holds one twice."""
    order = np.argsort(values, kind="stable")
    same = values[order][1:] == values[order][:-1]
    before, at = order[:-1][same], order[1:][same]
    near = at - before < length
    # Starts from which both places are inside: at - length + 1 to before.
    edge = np.zeros(len(values) + 1, np.int64)
    np.add.at(edge, np.maximum(at[near] - length + 1, 0), 1)
    np.add.at(edge, before[near] + 1, -1)
    return np.cumsum(edge)[: len(values) - length + 1] > 0


def window_prints(values: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Fingerprints of the windows of ``length`` shingles at each start, ascending."""
    out = np.zeros((len(starts), BITS // 64), np.uint64)
    twice = repeating(values, length)[starts]
    plain = np.flatnonzero(~twice)
    while len(plain):
        first = starts[plain[0]]
        here = plain[: np.searchsorted(starts[plain], first + _CHUNK)]
        sums = np.zeros((starts[here[-1]] - first + length + 1, BITS), np.int32)
        np.cumsum(_bits(values[first : starts[here[-1]] + length]), axis=0, dtype=np.int32, out=sums[1:])
        at = starts[here] - first
        out[here] = _packed((sums[at + length] - sums[at]) * 2 > length)
        plain = plain[len(here) :]
    step = max(1, _CHUNK // length)
    again = np.flatnonzero(twice)
    for low in range(0, len(again), step):
        here = again[low : low + step]
        rows = _numbered(values[starts[here][:, None] + np.arange(length)])
        counts = np.zeros((len(here), BITS), np.int64)
        for left in range(0, length, _CHUNK):
            part = rows[:, left : left + _CHUNK]
            counts += _bits(part.ravel()).reshape(*part.shape, BITS).sum(1, dtype=np.int64)
        out[here] = _packed(counts * 2 > length)
    return out


class MultiIndex:
    """Fingerprints by bit block: within the radius, at least one block agrees."""

    def __init__(self, values: np.ndarray, radius: int = RADIUS):
        self.values, self.radius = values, radius
        bits = np.unpackbits(values.view(np.uint8), axis=1, bitorder="little")
        self.edges = np.linspace(0, bits.shape[1], radius + 2).astype(int)
        self.blocks = []
        for key in self._keys(bits):
            order = np.argsort(key, kind="stable")
            self.blocks.append((key[order], order))

    def _keys(self, bits: np.ndarray) -> Iterator[np.ndarray]:
        for low, high in zip(self.edges, self.edges[1:], strict=False):
            yield bits[:, low:high] @ (1 << np.arange(high - low))

    def search(self, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs (query, value) within the radius, in parts."""
        step = max(1, _CELLS // len(self.values))
        for first in range(0, len(queries), step):
            part = np.ascontiguousarray(queries[first : first + step])
            seen = np.zeros((len(part), len(self.values)), bool)
            bits = np.unpackbits(part.view(np.uint8), axis=1, bitorder="little")
            for key, (keys, order) in zip(self._keys(bits), self.blocks, strict=True):
                low = np.searchsorted(keys, key)
                count = np.searchsorted(keys, key, "right") - low
                seen[np.repeat(np.arange(len(part)), count), order[W.ragged(low, count)]] = True
            query, value = np.nonzero(seen)
            apart = np.bitwise_count(part[query] ^ self.values[value]).sum(1, dtype=np.int64)
            near = apart <= self.radius
            yield first + query[near], value[near]


class Benchmark:
    """Items by their size in words, and the positions worth a window."""

    def __init__(self, items: list[tuple[object, bytes]]):
        sized: dict[int, list] = {}
        for key, text in items:
            data, _ = W.joined([text])
            hashed = W.hashes(data, *W.spans(data))
            if len(hashed):
                sized.setdefault(len(hashed), []).append((key, shingles(hashed)))
        self.sizes = {}
        for size, group in sorted(sized.items()):
            each = [values for _, values in group]
            prints = [window_prints(v, np.zeros(1, np.int64), len(v)) for v in each]
            known = np.unique(np.concatenate(each))
            self.sizes[size] = (group, MultiIndex(np.concatenate(prints)), known)
        parts = [known for _, _, known in self.sizes.values()]
        self.known = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
        width = max(16, int(len(self.known) * 16).bit_length())
        self.mask = np.uint64((1 << width) - 1)
        self.bitmap = np.zeros(1 << width, bool)
        self.bitmap[self.known & self.mask] = True

    def touched(self, values: np.ndarray) -> np.ndarray:
        """Positions whose shingle occurs in an item.

        A window without any has similarity zero, so leaving it out loses nothing.
        """
        maybe = np.flatnonzero(self.bitmap[values & self.mask])
        if not len(maybe):
            return maybe
        return maybe[_among(values[maybe], self.known)]

    def matches(self, hashed: np.ndarray) -> list[tuple[object, float, int, int]]:
        """(item, similarity, first word, words) of each item's best window in a text."""
        best: dict[object, tuple] = {}
        short: dict[int, np.ndarray] = {}
        for size, (group, index, known) in self.sizes.items():
            width = min(size, SHINGLE)
            if width < SHINGLE:
                values = short.setdefault(size, _short(hashed, size))
            else:
                values = short.setdefault(SHINGLE, shingles(hashed))
            if not len(values):
                continue
            whole = size - width + 1
            length = min(whole, len(values))
            # A window that shares no shingle with an item of this size has similarity zero.
            sums = np.concatenate(([0], np.cumsum(_among(values, known))))
            starts = np.flatnonzero(sums[length:] > sums[: len(sums) - length])
            if not len(starts):
                continue
            for query, found in index.search(window_prints(values, starts, length)):
                for item in np.unique(found).tolist():
                    near = starts[query[found == item]]
                    for start, value in verified(values, near, length, group[item][1]):
                        one = (value, -start, min(size, length + width - 1))
                        at = (size, item)
                        best[at] = max(best.get(at, one), one)
        return [
            (self.sizes[size][0][item][0], value, -start, count)
            for (size, item), (value, start, count) in sorted(best.items())
        ]


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is one of the sorted ``known``."""
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def verified(values: np.ndarray, starts: np.ndarray, length: int, item: np.ndarray) -> Iterator[tuple[int, float]]:
    """(start, similarity) of the windows at the starts that are similar enough to the item.

    A window's shingles that the item has at all bound what they share; only windows
    whose bound makes the similarity are compared shingle by shingle.
    """
    low, high = int(starts[0]), int(starts[-1]) + length
    sums = np.concatenate(([0], np.cumsum(_among(values[low:high], np.unique(item)))))
    need = SIMILARITY * (length + len(item)) / (1 + SIMILARITY) - 1e-9
    enough = sums[starts - low + length] - sums[starts - low] >= need
    for start in starts[enough].tolist():
        value = similarity(values[start : start + length], item)
        if value >= SIMILARITY:
            yield start, value


def _short(hashed: np.ndarray, size: int) -> np.ndarray:
    """Shingles for items of fewer words than a shingle: all runs of that many words."""
    count = len(hashed) - size + 1
    if count < 1:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total += hashed[k : k + count] * _FACTORS[k]
    return W.mix(total + np.uint64(size))


def similarity(left: np.ndarray, right: np.ndarray) -> float:
    """Weighted Jaccard similarity; a shingle weighs as often as it occurs."""
    a, b = Counter(left.tolist()), Counter(right.tolist())
    shared = sum((a & b).values())
    return shared / (len(left) + len(right) - shared)


def leaks(documents: DataFrame, benchmark: DataFrame, id_column: str = "doc_id",
          text_column: str = "text", item_column: str = "item_id",
          item_text_column: str = "text") -> DataFrame:
    """(id, item, similarity, start_word, n_words): items found in documents.

    One row for each document and item with a window of the item's size that is similar
    enough; its best window, the first of equals. Null and empty texts match nothing,
    nor do null or empty items; equal items match each; repeated rows are searched each;
    a text shorter than an item is one window. Other columns are not read.

    The benchmark is a stated query set: it travels with the tasks in blocks of at most
    ``BLOCK_BYTES`` (one longer item is a block of its own), each with one scan of the
    documents. Nothing is shuffled, so no key can be hot.
    """
    spark = documents.sparkSession
    id_kind = documents.schema[id_column].dataType.simpleString()
    item_kind = benchmark.schema[item_column].dataType.simpleString()
    schema = (
        f"id {id_kind}, item {item_kind}, similarity double, start_word bigint, n_words bigint"
    )
    rows = documents.select(
        F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")
    )
    items = benchmark.select(
        F.col(item_column).alias("item"), F.col(item_text_column).cast("string").alias("text")
    ).where(F.length("text") > 0)
    block, size, found = [], 0, spark.createDataFrame([], schema)
    for row in items.toLocalIterator():
        text = row["text"].encode()
        if block and size + len(text) > BLOCK_BYTES:
            found, block, size = found.union(_scan(rows, block, schema)), [], 0
        block.append((row["item"], text))
        size += len(text)
    return found.union(_scan(rows, block, schema)) if block else found


def _scan(rows: DataFrame, items: list, schema: str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(items)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Benchmark(shared.value)
        for batch in batches:
            found = []
            values = W.texts(batch.column(1))
            for low, high in W.slices(map(len, values), 1 << 21):
                for at, best in _documents(index, values[low:high]):
                    found += [(low + at, *one) for one in best]
            if found:
                at, item, value, start, count = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at)),
                        pa.array(item),
                        pa.array(value, pa.float64()),
                        pa.array(start, pa.int64()),
                        pa.array(count, pa.int64()),
                    ],
                    ["id", "item", "similarity", "start_word", "n_words"],
                )

    return rows.mapInArrow(search, schema)


def _documents(index: Benchmark, values: list[bytes]) -> Iterator[tuple[int, list]]:
    """The texts of a slice with matches; only those that share a shingle are searched."""
    if not index.sizes:
        return
    data, offsets = W.joined(values)
    starts, ends = W.spans(data)
    hashed = W.hashes(data, starts, ends)
    first = np.searchsorted(starts, offsets)
    owner = np.repeat(np.arange(len(values)), np.diff(first))
    if min(index.sizes) < SHINGLE:
        near = np.arange(len(values))
    else:
        near = np.unique(owner[index.touched(shingles(hashed))])
        # A text of fewer words than a shingle is one shingle, which no longer item has.
    for at in near.tolist():
        best = index.matches(hashed[first[at] : first[at + 1]])
        if best:
            yield at, best


def keep_clean(documents: DataFrame, benchmark: DataFrame, id_column: str = "doc_id",
               text_column: str = "text") -> DataFrame:
    """The documents without any leak, columns unchanged.

    Leaking rows leave by an anti join on a digest of id and text, so a clean row stays
    even if it shares its id with a leaking one; a null id protects none.
    """
    name = fresh(documents, "row_key")
    keyed = documents.withColumn(name, row_key(id_column, text_column))
    lost = leaks(keyed, benchmark, name, text_column)
    return without(documents, [id_column, text_column], lost.select("id"))
