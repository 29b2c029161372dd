from __future__ import annotations

import math
from collections import defaultdict

import numpy as np

from stockflow.llm import mixing as M
from tests.llm import brute


def targets(sizes):
    total, free = sum(sizes.values()), dict(zip(sorted(sizes, key=lambda s: (s is None, s)), [5, 2, 1] * len(sizes), strict=False))
    out = {}
    while free:
        left = total - sum(out.values())
        level = left / sum(free.values())
        over = {s for s in free if level * free[s] >= 3 * sizes[s]}
        if not over:
            return out | {s: level * w for s, w in free.items()}
        out |= {s: 3.0 * sizes[s] for s in over}
        free = {s: w for s, w in free.items() if s not in over}
    return out


def corpus():
    rng = np.random.default_rng(4)
    rows = []
    for k in range(600):
        source = "src0" if k % 3 == 0 else f"src{k % 7}" if k % 11 else None
        rows.append((k, " ".join(["w"] * int(rng.lognormal(4, 1) + 1)), source))
    return rows + [(9000, None, "src1"), (9001, "", None), (9002, "w " * 9, "tiny"), (None, "w w w", "src2"), (7, "w w", "src2")]


def test_sources_meet_their_targets(docs):
    rows = corpus()
    found = M.mix(docs(rows)).collect()
    assert len(found) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(brute.words(text))
    want = targets(sizes)
    for row in found:
        assert row["source_size"] == sizes[row["source"]]
        assert math.isclose(row["target"], want[row["source"]], rel_tol=1e-9)
        assert 0 <= row["copies"] <= 3
        taken[row["source"]] += row["copies"] * row["size"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= max(0.01 * target, 9), source


def test_order_and_blocks_do_not_matter(docs, monkeypatch):
    rows = corpus()
    key = lambda r: (str(r["id"]), r["size"], r["source"] or "", r["copies"])
    first = sorted(map(key, M.mix(docs(rows, 2)).collect()))
    assert first == sorted(map(key, M.mix(docs(rows[::-1], 7)).collect()))
    monkeypatch.setattr(M, "BLOCK_ROWS", 50)
    found = M.mix(docs(rows)).collect()
    taken, target = defaultdict(int), {}
    for row in found:
        taken[row["source"]] += row["copies"] * row["size"]
        target[row["source"]] = row["target"]
    assert all(abs(taken[s] - t) <= max(0.02 * t, 9) for s, t in target.items())


def test_tilts_solve_the_dual(docs, llm):
    sizes = [("a", 10, 5), ("a", 100, 2), ("b", 7, 3), ("b", 900, 1)]
    histogram = llm.createDataFrame(sizes, "source string, size bigint, n bigint")
    wanted = llm.createDataFrame([("a", 250, 500.0), ("b", 921, 100.0)], "source string, source_size bigint, target double")
    for row in M.tilts(histogram, wanted).collect():
        words = sum(n * s * 3 / (1 + 2 * math.exp(-row["tilt"] * s / row["scale"])) for of, s, n in sizes if of == row["source"])
        assert math.isclose(words, {"a": 500, "b": 100}[row["source"]], rel_tol=1e-6)


def test_empty_tables_and_texts(docs):
    assert M.mix(docs([])).collect() == []
    assert {r["copies"] for r in M.mix(docs([(1, None, "a"), (2, "", None)])).collect()} == {1}


def test_documents_are_repeated_with_their_columns(docs):
    rows = corpus()
    table = docs(rows)
    mixed = M.mixed(table)
    assert mixed.columns == table.columns
    copies = defaultdict(int)
    for row in M.mix(table).collect():
        copies[row["id"]] += row["copies"]
    found = defaultdict(int)
    for row in mixed.collect():
        found[row["doc_id"]] += 1
    assert {k: v for k, v in copies.items() if v} == found


def test_repeated_rows_meet_target_and_limit(docs):
    rows = [(1, "w " * 20, "src0")] * 700 + [(None, "v " * 20, "src0")] * 300
    rows += [(1, "w " * 20, "src1")] * 200 + [(k, "w " * (k % 30 + 1), "src1") for k in range(10, 300)]
    rows += [(k, "w " * (k % 30 + 1), "src2") for k in range(300, 500)]
    table = docs(rows)
    sizes, taken, mixed = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(brute.words(text))
    found = M.mix(table).collect()
    assert len(found) == len(rows)
    for row in found:
        assert 0 <= row["copies"] <= 3
        taken[row["source"]] += row["copies"] * row["size"]
    for row in M.mixed(table).collect():
        mixed[row["source"]] += len(brute.words(row["text"]))
    assert mixed == taken
    for source, target in targets(sizes).items():
        assert abs(taken[source] - target) <= 20, source
