"""Elias-Fano sequences and the n-gram trie built from them, in flat memory.

Everything is a run of 8-byte words, so a trie is one buffer that can be mapped from a
file; nothing is decoded to be searched. All operations take arrays of queries.
"""

from __future__ import annotations

import numpy as np

_CHUNK = 1 << 15
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _select(words: np.ndarray, before: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Positions of the set bits of given rank; ``before`` counts them before each word."""
    out = np.empty(len(rank), np.int64)
    for low in range(0, len(rank), _CHUNK):
        r = rank[low : low + _CHUNK]
        word = np.searchsorted(before, r, side="right") - 1
        bits = np.unpackbits(words[word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        seen = np.cumsum(bits, axis=1, dtype=np.uint8)
        inside = (seen <= (r - before[word]).astype(np.uint8)[:, None]).sum(1)
        out[low : low + _CHUNK] = word * 64 + inside
    return out


class Packed:
    """Numbers of a fixed width of bits."""

    def __init__(self, width: int, words: np.ndarray):
        self.width, self.words = width, words

    @classmethod
    def of(cls, values: np.ndarray, width: int) -> Packed:
        count = len(values) * width
        words = np.zeros(count // 64 + 2, np.uint64)
        if width and len(values):
            place = np.arange(len(values), dtype=np.int64) * width
            at, shift = place >> 6, (place & 63).astype(np.uint64)
            np.bitwise_or.at(words, at, values << shift)
            over = np.flatnonzero((place & 63) + width > 64)
            np.bitwise_or.at(words, at[over] + 1, values[over] >> (np.uint64(64) - shift[over]))
        return cls(width, words)

    def __getitem__(self, index: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(index), np.uint64)
        place = index.astype(np.int64) * self.width
        at, shift = place >> 6, (place & 63).astype(np.uint64)
        low = self.words[at] >> shift
        high = np.where(shift > 0, self.words[at + 1] << ((np.uint64(64) - shift) & np.uint64(63)), 0)
        return (low | high) & (_ALL >> np.uint64(64 - self.width))


class EliasFano:
    """A sequence that never falls: low bits packed, high bits in unary."""

    def __init__(self, size: int, low: Packed, high: np.ndarray):
        self.size, self.low, self.high = size, low, high
        ones = np.bitwise_count(high).astype(np.int64)
        self.ones = np.cumsum(ones) - ones
        self.zeros = np.arange(len(high), dtype=np.int64) * 64 - self.ones
        self.buckets = len(high) * 64 - size

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        size, top = len(values), int(values[-1]) if len(values) else 0
        width = max(0, (top // max(size, 1)).bit_length() - 1)
        place = (values >> np.uint64(width)).astype(np.int64) + np.arange(size)
        bits = np.zeros(((top >> width) + size) // 64 + 2, np.uint64)
        np.bitwise_or.at(bits, place >> 6, np.uint64(1) << (place & 63).astype(np.uint64))
        mask = _ALL >> np.uint64(64 - width) if width else np.uint64(0)
        return cls(size, Packed.of(values & mask, width), bits)

    def __getitem__(self, index: np.ndarray) -> np.ndarray:
        high = (_select(self.high, self.ones, index) - index).astype(np.uint64)
        return (high << np.uint64(self.low.width)) | self.low[index]

    def successor(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first element that is not smaller, and whether it is equal."""
        width = np.uint64(self.low.width)
        bucket = np.minimum(values >> width, np.uint64(self.buckets - 1)).astype(np.int64)
        rest = values & (_ALL >> np.uint64(64 - self.low.width)) if self.low.width else np.zeros_like(values)
        flipped = ~self.high
        stop = _select(flipped, self.zeros, bucket) - bucket
        start = np.zeros_like(stop)
        later = bucket > 0
        start[later] = _select(flipped, self.zeros, bucket[later] - 1) - bucket[later] + 1
        end = stop.copy()
        while (open_ := start < stop).any():
            at = np.flatnonzero(open_)
            middle = (start[at] + stop[at]) >> 1
            less = self.low[middle] < rest[at]
            start[at[less]] = middle[less] + 1
            stop[at[~less]] = middle[~less]
        inside = start < end
        equal = np.zeros(len(values), bool)
        at = np.flatnonzero(inside)
        equal[at] = self.low[start[at]] == rest[at]
        return start, equal & ((values >> width).astype(np.int64) == bucket)

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.size, self.low.width], np.uint64), self.low.words, self.high]

    @classmethod
    def load(cls, parts: list[np.ndarray]) -> EliasFano:
        head, low, high = parts
        return cls(int(head[0]), Packed(int(head[1]), low), high)


class Trie:
    """N-grams by context: a level for each word, pointers from one level to the next.

    A level holds the children of all nodes of the level above in one sequence that
    never falls: each run starts where the last one ended, so an id is stored relative
    to its context, and it is found by the successor of context base + id, within the
    run of the context. Each n-gram has a code (a quantised probability), each context
    of the level above one too (its weight for words that never followed).
    """

    def __init__(self, levels: list[EliasFano], pointers: list[EliasFano], codes: Packed, weights: Packed):
        self.levels, self.pointers, self.codes, self.weights = levels, pointers, codes, weights

    @classmethod
    def of(cls, grams: np.ndarray, codes: np.ndarray, weights: np.ndarray, bits: int = 16) -> Trie:
        """From distinct n-grams (rows of ids above zero) in ascending order."""
        size, order = grams.shape
        levels, pointers = [], []
        new = np.zeros(size, bool)
        parent = np.zeros(size, np.int64)
        for k in range(order):
            fresh = new.copy()
            if size:
                fresh[0] = True
                fresh[1:] |= grams[1:, k] != grams[:-1, k]
            node = np.flatnonzero(fresh)
            ids, above = grams[node, k].astype(np.uint64), parent[node]
            first = np.flatnonzero(np.r_[True, above[1:] != above[:-1]][: len(node)])
            if k:
                pointers.append(EliasFano.of(np.r_[first, len(node)]))
                last = np.r_[first[1:], len(node)] - 1
                base = np.cumsum(ids[last]) - ids[last]
                ids = ids + np.repeat(base, np.diff(np.r_[first, len(node)]))
            levels.append(EliasFano.of(ids))
            new, parent = fresh, np.cumsum(fresh) - 1
        return cls(levels, pointers, Packed.of(codes.astype(np.uint64), bits), Packed.of(weights.astype(np.uint64), bits))

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the context, index of the n-gram), -1 where there is none."""
        count, order = grams.shape
        context, at = np.full(count, -1, np.int64), np.full(count, -1, np.int64)
        live, node = np.arange(count), np.zeros(count, np.int64)
        for k, level in enumerate(self.levels):
            if not len(live) or not level.size:
                return context, at
            ids = grams[live, k].astype(np.uint64)
            if k:
                low = self.pointers[k - 1][node].astype(np.int64)
                high = self.pointers[k - 1][node + 1].astype(np.int64)
                base = np.zeros(len(live), np.uint64)
                later = low > 0
                base[later] = level[low[later] - 1]
                found, equal = level.successor(base + ids)
                equal &= (found >= low) & (found < high)
            else:
                found, equal = level.successor(ids)
            live, node = live[equal], found[equal]
            if k == order - 2:
                context[live] = node
        at[live] = node
        return context, at

    def to_bytes(self) -> bytes:
        parts = [p for s in [*self.levels, *self.pointers] for p in s.parts()]
        for packed in (self.codes, self.weights):
            parts += [np.array([packed.width], np.uint64), packed.words]
        head = np.array([len(self.levels), *map(len, parts)], np.uint64)
        return b"".join([np.uint64(len(head)).tobytes(), head.tobytes(), *(p.tobytes() for p in parts)])

    @classmethod
    def load(cls, words: np.ndarray) -> Trie:
        """From the 8-byte words of ``to_bytes``, mapped or in memory; copies nothing."""
        count = int(words[0])
        head = words[1 : 1 + count].astype(np.int64)
        ends = np.cumsum(head[1:]) + 1 + count
        parts = [words[e - n : e] for e, n in zip(ends, head[1:], strict=True)]
        order = int(head[0])
        loaded = [EliasFano.load(parts[3 * k : 3 * k + 3]) for k in range(2 * order - 1)]
        rest = parts[3 * (2 * order - 1) :]
        codes, weights = (Packed(int(rest[k][0]), rest[k + 1]) for k in (0, 2))
        return cls(loaded[:order], loaded[order:], codes, weights)
