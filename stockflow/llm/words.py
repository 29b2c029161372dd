"""Words of byte texts, vectorised: splitting, hashing, batching."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

# The word pattern of the operators, and A-Z in lower case.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64)] * 2


def _powers_to(length: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < length:
        for at, base in enumerate((_ODD, _INVERSE)):
            steps = np.full(length, base, np.uint64)
            steps[0] = 1
            _powers[at] = np.multiply.accumulate(steps)
    return _powers[0][:length], _powers[1][:length]


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a byte array start and end."""
    inside = np.empty(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(_SPACE[data], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span; equal bytes give equal hashes anywhere."""
    powers, inverse = _powers_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers[:-1], out=sums[1:])
    value = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(value + mix((ends - starts).astype(np.uint64)))


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """A string column as bytes; null is empty."""
    return [value or b"" for value in column.cast(pa.large_binary()).to_pylist()]


def slices(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``limit`` bytes, or of one longer row."""
    low, total, at = 0, 0, -1
    for at, size in enumerate(sizes):
        if total and total + size > limit:
            yield low, at
            low, total = at, 0
        total += size + 1
    if at >= low:
        yield low, at + 1


def joined(values: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Texts in one byte array, a line end after each, and where each one starts."""
    data = b"\n".join([*values, b""])
    if lower:
        data = data.translate(LOWER)
    lengths = np.fromiter((len(v) + 1 for v in values), np.int64, len(values))
    return np.frombuffer(data, np.uint8), np.concatenate(([0], np.cumsum(lengths)))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices ``start, start + 1, …`` of all runs, one run after the other."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - first, lengths)
