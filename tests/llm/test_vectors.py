from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockflow.llm import hard_negatives, queries, top_products, vectors
from tests.compare import difference

SF = "/root/testdata/sf0.01"
SCHEMA = (
    "vec_id bigint, embedding array<float>, label int, id string, v string, score string, "
    "asks string, part string, at string, rank string, floor string, nth string"
)


@pytest.fixture
def table(llm):
    def make(rows, partitions=3):
        return llm.createDataFrame([(*row, *"abcdefghi") for row in rows], SCHEMA).repartition(partitions)

    return make


def usable(rows):
    for vec_id, vector, label in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            yield vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], label


def product(a, b):
    return sum(x * y for x, y in zip(a, b, strict=False))


def order(vec_id, score):
    return -score, vec_id is None, vec_id or 0


def brute_top(rows, divisor, k):
    rows, out = list(usable(rows)), []
    for at, (query, vector, _) in enumerate(rows):
        if query is not None and query % divisor == 0:
            others = [(c, product(vector, w)) for o, (c, w, _) in enumerate(rows) if o != at]
            ranked = sorted(others, key=lambda one: order(*one))[:k]
            out += [(query, n, c, s) for n, (c, s) in enumerate(ranked, 1)]
    return sorted(out, key=str)


def brute_mine(rows, divisor):
    out = []
    rows = [
        (i, v, None if t is None else (t + 1) % 10 if i is not None and i % 7 == 0 else t)
        for i, v, t in usable(rows)
    ]
    rows = [row for row in rows if row[2] is not None]
    for at, (anchor, vector, label) in enumerate(rows):
        if anchor is None or anchor % divisor:
            continue
        scored = [(c, product(vector, w), t) for o, (c, w, t) in enumerate(rows) if o != at]
        scored.sort(key=lambda one: order(one[0], one[1]))
        for positive, score, _ in [one for one in scored if one[2] == label][:5]:
            near = [one for one in scored if one[2] != label and 30 * score <= 100 * one[1] <= 90 * score]
            out += [(anchor, positive, n, c, score, s) for n, (c, s, _) in enumerate(near[:10], 1)]
    return sorted(out, key=str)


def some_rows(count, dims, seed=5, spread=1.0):
    rng = random.Random(seed)
    rows = []
    for at in range(count):
        vector = [rng.gauss(0, spread) for _ in range(dims)]
        if at % 3 == 0:
            vector = [0.5 * spread] * dims  # a third of all rows
        rows.append((at, vector, rng.choice([0, 0, 0, 1, 2, 9])))
    rows += [
        (5000, None, 1), (5050, [], 1), (5100, [0.1] * (dims - 1) + [None], 1), (5150, [math.nan] * dims, 1),
        (5200, [math.inf] + [0.0] * (dims - 1), 2), (None, [0.9] * dims, 0), (None, [0.9] * dims, 1),
        (5300, [0.0] * dims, 0), (5400, [-0.7] * dims, 0), (5500, [0.3] * (dims // 2), 1), (5600, [0.2] * dims, None),
        (100, rows[100][1], 0), (100, rows[100][1], 0), (200, [-0.001] * dims, 2),
    ]
    return rows


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 37)


@pytest.mark.parametrize("dims", [1, 2, 16])
def test_top_rows_equal_brute_force(table, small, dims):
    rows = some_rows(400, dims)
    found = top_products.top_k(table(rows), F.col("vec_id") % 50 == 0, 5)
    assert sorted(map(tuple, found.collect()), key=str) == brute_top(rows, 50, 5)


def test_cells_of_any_size_give_the_same(table, small, monkeypatch):
    rows = some_rows(300, 8)
    expected = brute_top(rows, 20, 3)
    whole = vectors.in_cells
    for cell in ({"cell_rows": 50, "cell_queries": 4}, {"cell_rows": 10**6, "cell_queries": 1}):
        monkeypatch.setattr(vectors, "in_cells", lambda *a, c=cell: whole(*a, **c))
        found = top_products.top_k(table(rows), F.col("vec_id") % 20 == 0, 3)
        assert sorted(map(tuple, found.collect()), key=str) == expected


def test_the_bound_ends_a_search_early():
    rng = np.random.default_rng(1)
    values = rng.integers(-20, 20, (4000, 6))
    values[77] = 250
    lists, best = top_products.Lists(values), top_products.Best(1)
    depth = lists.top(np.full(6, 9), best, np.zeros(4000, bool), np.arange(4000))
    assert best.ids.tolist() == [77] and depth < 100


def test_negatives_equal_brute_force(table, small):
    for dims, spread in ((3, 1.0), (16, 0.4), (12, 90.0)):
        rows = some_rows(300, dims, spread=spread)
        label = F.col("label").cast("bigint")
        found = hard_negatives.mine(
            table(rows), F.col("vec_id") % 50 == 0,
            F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label),
        )
        result = sorted(map(tuple, found.collect()), key=str)
        assert result and result == brute_mine(rows, 50)


def test_packed_products_are_exact():
    rng = np.random.default_rng(2)
    for size, kind in ((300, "<u4"), (10**7, "<u8")):
        values, anchor = rng.integers(-size, size, (500, 64)), rng.integers(-size, size, 64)
        packed = hard_negatives.Packed(values, int(anchor.min()), int(anchor.max()))
        assert packed.kind == kind
        assert (packed.scores(anchor) == values @ anchor).all()
    with pytest.raises(OverflowError):
        hard_negatives.Packed(np.full((2, 8), 2**40), -(2**30), 2**30)


def test_no_rows(table):
    empty = table([])
    assert top_products.top_k(empty, F.col("vec_id") % 50 == 0).collect() == []
    assert hard_negatives.mine(empty, F.col("vec_id") % 50 == 0, F.col("label")).collect() == []
    unusable = table([(0, None, 1), (50, [None], 1)])
    assert top_products.top_k(unusable, F.col("vec_id") % 50 == 0).collect() == []


@pytest.mark.parametrize("name", ["op11_threshold_top", "op13_kronecker_negatives"])
def test_queries_equal_their_twins(llm, name):
    found = queries.QUERIES[name](llm, SF)
    assert difference(found, SF, queries.ORACLE[name]) is None
