"""Periodic runs of words: squares caught online by dyadic blocks.

A block of 2^k words becomes a catcher as soon as it is complete; a catcher starts every
half block. It waits for the first later place where its words recur. If that is more than
half a block and at most a block away, the two are a square's halves, or contain them, and
the distance is the period. Neighbouring catchers with one period merge into a run, whose
ends are found by comparing words a period apart.

Why none is missed: a run of smallest period q and at least four periods holds, for the
block length 2^k with q <= 2^k < 2q, a catcher and its copy q words later. A block of at
least q words cannot recur sooner inside the run, or q would not be its smallest period.
For the same reason no multiple of the period is ever caught.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm import words as W

SLAB_WORDS = 1 << 18
TEXT_BYTES = 1 << 22
_ODD = np.uint64(0x9E3779B97F4A7C15)
# The argument above needs so many periods.
LEAST_POWER = 4


class Catchers:
    """Runs of a sequence that is appended piece by piece; the cuts do not matter.

    A level, all catchers of one block length, is advanced when a further block of it is
    complete, over the words since then and two blocks before. Each level therefore reads
    every word about three times in all. Words are compared as whole numbers.
    """

    def __init__(self, least: int = 6, power: int = LEAST_POWER):
        if power < LEAST_POWER:
            raise ValueError(f"runs of fewer than {LEAST_POWER} periods are not caught")
        self.least, self.power = least, power
        self._words = np.empty(1024, np.uint64)
        self.size = 0
        self._seen: dict[int, int] = {}
        self._caught: list[tuple[np.ndarray, np.ndarray]] = []

    def append(self, words: np.ndarray) -> int:
        """Add words; returns how many squares' halves their arrival has caught."""
        end = self.size + len(words)
        if end > len(self._words):
            grown = np.empty(max(end, 2 * len(self._words)), np.uint64)
            grown[: self.size] = self._words[: self.size]
            self._words = grown
        self._words[self.size : end] = words
        self.size = end
        return self._advance(final=False)

    def _advance(self, final: bool) -> int:
        due, block = [], 1
        # A block longer than this has no period that fits the least number of times.
        while self.power * (block // 2 + 1) <= self.size:
            waiting = self.size - self._seen.get(block, 0)
            if waiting >= block or (final and waiting):
                due.append(block)
            block *= 2
        if not due:
            return 0
        low = min(max(0, self._seen.get(block, 0) - 2 * block) for block in due)
        caught = self._catch(low, set(due))
        self._seen |= dict.fromkeys(due, self.size)
        return caught

    def _catch(self, low: int, due: set[int]) -> int:
        """Catch squares of the due block lengths among the words from ``low`` on.

        Blocks get names that are equal for equal words; a block of twice the length is
        named by its halves. A block that occurs once has no longer one that recurs.
        """
        size = self.size - low
        names = np.zeros(size, np.uint64)
        recurs = np.zeros(size, bool)
        at, value = np.arange(size), W.mix(self._words[low : self.size])
        block, caught, top = 1, 0, max(due)
        while len(at):
            order = np.argsort(value, kind="stable")
            place, value = at[order], value[order]
            same = value[1:] == value[:-1]
            if block in due:
                start, again = place[:-1][same], place[1:][same]
                period = again - start
                good = (2 * period > block) & (period <= block)
                good &= (start + low) % max(1, block // 2) == 0
                self._caught.append((start[good] + low, period[good]))
                caught += int(good.sum())
            if block == top:
                break
            either = np.zeros(len(place), bool)
            either[:-1] |= same
            either[1:] |= same
            recurs[:] = False
            recurs[place[either]] = True
            names[place] = value
            at = np.flatnonzero(recurs[: size - block] & recurs[block:])
            at = at[at <= size - 2 * block]
            value = W.mix(names[at] * _ODD + names[at + block])
            block *= 2
        return caught

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, period) of all runs so far, by start and period."""
        self._advance(final=True)
        start = np.concatenate([np.empty(0, np.int64), *(s for s, _ in self._caught)])
        period = np.concatenate([np.empty(0, np.int64), *(q for _, q in self._caught)])
        order = np.lexsort((start, period))
        start, period = start[order], period[order]
        block = _power_of_two(period)
        new = np.ones(len(start), bool)
        new[1:] = (period[1:] != period[:-1]) | (start[1:] - start[:-1] > block[1:])
        first = start[new]
        last = start[np.append(new[1:], True)] if len(start) else first
        period, block = period[new], block[new]
        step = np.maximum(block // 2, 1)
        need = np.maximum(self.least, self.power * period)
        # Beyond its catchers a run has less than a step on either side.
        good = last + block - first + 2 * step + period >= need
        first, last, period, block, step, need = (
            values[good] for values in (first, last, period, block, step, need)
        )
        good = self._whole(first, last + block, period)
        left = self._more(first - 1, period, step, -1)
        right = self._more(last + block, period, step, 1)
        begin = first - left
        length = last + block + right - begin + period
        good &= length >= need
        begin, length, period = begin[good], length[good], period[good]
        order = np.lexsort((period, begin))
        return begin[order], length[order], period[order]

    def _equal(self, at: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Whether the words at these places and a period later are equal."""
        inside = (at >= 0) & (at + period < self.size)
        at = np.where(inside, at, 0)
        later = np.where(inside, at + period, 0)
        return inside & (self._words[at] == self._words[later])

    def _whole(self, low: np.ndarray, high: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Whether all words of each stretch recur after the period; names could collide."""
        if not len(low):
            return np.zeros(0, bool)
        lengths = high - low
        equal = self._equal(W.ragged(low, lengths), np.repeat(period, lengths))
        return np.logical_and.reduceat(equal, np.cumsum(lengths) - lengths)

    def _more(self, start: np.ndarray, period: np.ndarray, most: np.ndarray, way: int) -> np.ndarray:
        """How many words from a place on keep the period, up to ``most`` of them."""
        if not len(start):
            return start
        step = W.ragged(np.zeros(len(most), np.int64), most)
        equal = self._equal(np.repeat(start, most) + way * step, np.repeat(period, most))
        kept = np.where(equal, np.repeat(most, most), step)
        return np.minimum.reduceat(kept, np.cumsum(most) - most)


def _power_of_two(values: np.ndarray) -> np.ndarray:
    """The least power of two that is not smaller."""
    powers = 1 << np.arange(62, dtype=np.int64)
    return powers[np.searchsorted(powers, values)]


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
         least: int = 6, power: int = LEAST_POWER) -> DataFrame:
    """(id, n_words, runs, collapsed): the periodic runs of every text.

    ``runs`` is an array of (start, length, period) by start and period: stretches of at
    least ``power`` times their smallest period and ``least`` words that no neighbouring
    word extends; words are numbered from 0. ``collapsed`` is the text without the words
    that lie in a run behind its first period, its words joined by one space.

    Null and empty texts, and texts of white space, have no words, no runs and an empty
    collapsed text. Rows are worked on each by itself, repeated ones too; null ids stay;
    other columns are not read. A text of any length is appended slab by slab. Nothing is
    shuffled. Words are compared exactly: within a slab of texts they are numbered.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(
        F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = W.texts(batch.column(1))
            for low, high in W.slices(map(len, values), TEXT_BYTES):
                sizes, runs, collapsed = _texts(values[low:high], least, power)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), sizes, runs, collapsed],
                    ["id", "n_words", "runs", "collapsed"],
                )

    return rows.mapInArrow(
        search,
        f"id {kind}, n_words bigint, "
        "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string",
    )


def _texts(values: list[bytes], least: int, power: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Word counts, runs and collapsed texts; all texts are one sequence of words.

    A word's number holds the text's number, so that no run crosses two texts.
    """
    split = [text.split() for text in values]
    sizes = np.array([len(words) for words in split], np.int64)
    first = np.cumsum(sizes) - sizes
    number = defaultdict(count().__next__)
    catchers = Catchers(least, power)
    held, waiting = [], 0
    for at, words in enumerate(split):
        # Each word keeps its number for the whole slab; the text's is above it.
        codes = np.fromiter(map(number.__getitem__, words), np.uint64, len(words))
        held.append(codes | np.uint64(at << 32))
        waiting += len(words)
        if waiting >= SLAB_WORDS:
            _append(catchers, held)
            held, waiting = [], 0
    _append(catchers, held)
    start, length, period = catchers.runs()
    text = np.searchsorted(first, start, "right") - 1
    dropped = np.zeros(catchers.size + 1, np.int64)
    np.add.at(dropped, start + period, 1)
    np.add.at(dropped, start + length, -1)
    dropped = np.cumsum(dropped) > 0
    collapsed = []
    cut = np.zeros(len(values), bool)
    cut[text] = True
    for at, words in enumerate(split):
        if cut[at]:
            lost = dropped[first[at] : first[at] + len(words)]
            words = [word for word, gone in zip(words, lost.tolist(), strict=True) if not gone]
        collapsed.append(b" ".join(words))
    offsets = np.searchsorted(text, np.arange(len(values) + 1)).astype(np.int32)
    runs = pa.StructArray.from_arrays(
        [pa.array(start - first[text]), pa.array(length), pa.array(period)],
        ["start", "length", "period"],
    )
    return (
        pa.array(sizes),
        pa.ListArray.from_arrays(pa.array(offsets), runs),
        pa.array(collapsed, pa.binary()).cast(pa.string()),
    )


def _append(catchers: Catchers, held: list[np.ndarray]) -> None:
    """Append words a slab at a time, also those of a text longer than a slab."""
    codes = np.concatenate([np.empty(0, np.uint64), *held])
    for low in range(0, len(codes), SLAB_WORDS):
        catchers.append(codes[low : low + SLAB_WORDS])
