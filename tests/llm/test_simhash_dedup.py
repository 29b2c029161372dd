from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from stockflow.llm import simhash_dedup as S
from stockflow.llm.graph import components
from tests.llm import brute


def expected(rows, radius=4):
    prints = [brute.fingerprint(text) for _, text, *_ in rows]
    near = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if (prints[i] ^ prints[j]).bit_count() <= radius
    ]
    root = brute.components(len(rows), near)
    names = {}
    for at, row in enumerate(rows):
        if row[0] is not None:
            names[root[at]] = min(names.get(root[at], row[0]), row[0])
    return [
        (row[0], prints[at] - (1 << 64) * (prints[at] >> 63), names.get(root[at]))
        for at, row in enumerate(rows)
    ]


def key(row):
    return [(v is None, v) for v in row]


def test_edge_rows_match_brute_force(docs, edges):
    found = [tuple(r) for r in S.near_duplicates(docs(edges)).collect()]
    assert sorted(found, key=key) == sorted(expected(edges), key=key)


def test_documents_match_brute_force(llm):
    table = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    found = [tuple(r) for r in S.near_duplicates(table).collect()]
    assert sorted(found) == sorted(expected(rows))


def test_an_empty_table_has_no_rows(docs):
    assert S.near_duplicates(docs([])).collect() == []


@pytest.mark.parametrize("radius,agree", [(4, 1), (8, 2), (3, 2)])
def test_any_pair_within_the_radius_agrees_under_a_mask(radius, agree):
    rng = np.random.default_rng(radius)
    for _ in range(300):
        value = int(rng.integers(0, 1 << 63))
        other = value
        for bit in rng.choice(64, radius, replace=False):
            other ^= 1 << int(bit)
        assert any(value & m == other & m for m in S.masks(radius, agree))


@pytest.mark.parametrize("bits", [6, 10, 64])
def test_forest_links_match_brute_force(bits):
    rng = np.random.default_rng(bits)
    values = np.unique(rng.integers(0, 1 << min(bits, 62), 300, dtype=np.uint64))
    if bits == 64:
        flips = np.uint64(1) << rng.integers(0, 64, (len(values), 3)).astype(np.uint64)
        values = np.unique(np.r_[values, values ^ flips[:, 0], values ^ flips[:, 1] ^ flips[:, 2]])
    rng.shuffle(values)
    groups = np.sort(rng.integers(0, 4, len(values)))
    radius = 1 if bits < 64 else 4
    near = [
        (i, j)
        for i in range(len(values))
        for j in range(i)
        if groups[i] == groups[j] and int(values[i] ^ values[j]).bit_count() <= radius
    ]
    assert S.forest_links(values, groups, radius, step=50).tolist() == brute.components(len(values), near)


def test_a_shard_beyond_one_tree_keeps_its_links(llm, monkeypatch):
    monkeypatch.setattr(S, "SLICE", 16)
    values = [(k, k ^ (k >> 1), []) for k in range(1, 400)]
    rows = llm.createDataFrame(values, "vertex bigint, fp bigint, wide array<bigint>")
    reached = {r["vertex"]: r["root"] for r in components(S.links(rows, 1)).collect()}
    assert len(set(reached.values())) == 1 and len(reached) == 398


def test_blocks_that_agree_grow_with_the_data_and_change_nothing(llm, monkeypatch):
    assert [S.agreeing(10**k, 4) for k in (0, 4, 7, 9, 11)] == [1, 1, 1, 2, 3]
    table = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one = sorted(map(tuple, S.near_duplicates(table).collect()))
    monkeypatch.setattr(S, "_HELD", 8)
    assert sorted(map(tuple, S.near_duplicates(table, agree=2).collect())) == one


def test_tables_cut_no_shard(monkeypatch):
    monkeypatch.setattr(S, "_HELD", 4)
    shards = [1, 1, 2, 2, 2, 2, 2, 2, 2, 3, 4, 5, 5]
    batches = [pa.record_batch({"shard": shards[k : k + 3]}) for k in range(0, len(shards), 3)]
    parts = [table["shard"].to_pylist() for table in S._whole_shards([pa.record_batch({"shard": pa.array([], pa.int64())}), *batches])]
    assert sum(parts, []) == shards
    assert all(a[-1] != b[0] for a, b in zip(parts, parts[1:], strict=False)) and len(parts) > 2


def test_components_match_brute_force(llm):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 120, (90, 2))]
    pairs += [(k, k + 1) for k in range(200, 260)] + [(300, 300), (5, 6), (6, 5)]
    frame = llm.createDataFrame(pairs, "a bigint, b bigint")
    root = brute.components(301, pairs)
    want = {v: root[v] for pair in pairs for v in pair if root[v] != v}
    assert {r["vertex"]: r["root"] for r in components(frame).collect()} == want
