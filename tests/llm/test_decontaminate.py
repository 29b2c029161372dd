from __future__ import annotations

import numpy as np

from stockflow.llm import decontaminate as D
from tests.llm import brute


def expected(rows, items):
    out = {}
    for at, (key, text, *_) in enumerate(rows):
        for item, passage in items:
            size = len(brute.words(passage))
            if not size:
                continue
            parts = brute.words(text, True)
            length = min(size, len(parts))
            width = min(size, 5)
            grams = lambda w: [" ".join(w[k : k + width]) for k in range(max(0, len(w) - width + 1))]
            wanted, best = grams(brute.words(passage, True)), 0.0
            for start in range(len(parts) - length + 1 if length >= width else 0):
                best = max(best, brute.jaccard(grams(parts[start : start + length]), wanted))
            if best >= 0.8:
                out[at, key, item] = best
    return out


def run(llm, table, items):
    benchmark = llm.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, id string")
    return D.leaks(table, benchmark)


def test_rows_match_brute_force(llm, docs, edges):
    rng = np.random.default_rng(2)
    passage = lambda n: [f"w{int(k)}" for k in rng.integers(0, 900, n)]
    items = [(k, " ".join(passage(n))) for k, n in enumerate((16, 25, 40, 59, 5, 3, 1))]
    items += [(20, None), (21, ""), (22, items[0][1]), (23, "One two three four five six seven.")]
    rows = list(edges)
    for k in range(60):
        parts = passage(150)
        if k % 2:
            own = brute.words(items[k % 4][1])
            if k % 3 == 0:
                own = own[:-1] + ["other"]
            parts[20:20] = [w.upper() for w in own]
        rows.append((100 + k, "\n".join(parts) if k % 5 else " ".join(parts)))
    rows.append((500, items[2][1].rsplit(" ", 2)[0]))
    rows.append((501, items[1][1] + " " + items[1][1]))
    found = run(llm, docs(rows), items).collect()
    want = expected(rows, items)
    assert sorted((str(r["id"]), r["item"], round(r["similarity"], 9)) for r in found) == sorted(
        (str(key), item, round(value, 9)) for (_, key, item), value in want.items()
    )


def test_blocks_of_items_give_the_same_rows(llm, docs, monkeypatch):
    items = [(k, " ".join(f"i{k}w{j}" for j in range(20))) for k in range(6)]
    table = docs([(k, f"before {text} after") for k, text in items])
    whole = sorted(map(tuple, run(llm, table, items).collect()))
    monkeypatch.setattr(D, "BLOCK_BYTES", 200)
    assert sorted(map(tuple, run(llm, table, items).collect())) == whole and len(whole) == 6


def test_empty_tables_and_removal(llm, docs):
    items = [(1, " ".join(f"w{j}" for j in range(20)))]
    assert run(llm, docs([]), items).collect() == []
    assert run(llm, docs([(1, items[0][1])]), []).collect() == []
    table = docs([(1, items[0][1]), (2, "clean"), (None, "clean too")])
    benchmark = llm.createDataFrame(items, "item_id bigint, text string")
    kept = D.keep_clean(table, benchmark)
    assert kept.columns == table.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "None"]


def test_only_the_leaking_rows_of_an_id_go(llm, docs):
    leak = " ".join(f"w{j}" for j in range(20))
    table = docs([(1, leak), (1, "clean of the same id"), (None, leak), (None, "clean"), (3, None), (4, leak.upper())])
    kept = D.keep_clean(table, llm.createDataFrame([(1, leak)], "item_id bigint, text string"))
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in kept.collect()) == [
        ("1", "clean of the same id"), ("3", ""), ("None", "clean"),
    ]


def test_the_index_finds_all_within_the_radius():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 63, (50, 4), dtype=np.uint64)
    queries = []
    for flips in (0, 7, 60, 88, 89, 120):
        bits = np.unpackbits(values.view(np.uint8), axis=1)
        for row in bits:
            row[rng.choice(256, flips, replace=False)] ^= 1
        queries.append(np.packbits(bits, axis=1).view(np.uint64))
    queries = np.concatenate(queries)
    found = {
        pair
        for part in D.MultiIndex(values).search(queries)
        for pair in zip(*(a.tolist() for a in part), strict=True)
    }
    apart = np.bitwise_count(queries[:, None] ^ values[None]).sum(2)
    assert found == set(zip(*(a.tolist() for a in np.nonzero(apart <= D.RADIUS)), strict=True))
    assert len(found) >= 200


def test_window_prints_match_numbered_shingles(monkeypatch):
    rng = np.random.default_rng(4)
    values = np.concatenate([rng.integers(0, 1 << 62, 60), rng.integers(0, 5, 40), np.zeros(30)]).astype(np.uint64)
    for chunk, length in ((1 << 14, 7), (16, 30), (8, 1), (1 << 14, 130)):
        monkeypatch.setattr(D, "_CHUNK", chunk)
        starts = np.arange(len(values) - length + 1)
        got = D.window_prints(values, starts, length)
        for start in starts.tolist():
            window = values[start : start + length]
            assert D.repeating(values, length)[start] == (len(np.unique(window)) < length)
            ones = D._bits(D._numbered(window[None])[0]).sum(0) * 2 > length
            assert (got[start] == D._packed(ones[None])[0]).all()


def test_windows_at_the_threshold_are_within_the_radius():
    # Swapped shingles, texts shorter than the item, and repeats that outweigh the rest.
    rng = np.random.default_rng(6)
    fresh = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64)
    for n in (9, 18, 45, 200):
        for kind in range(4):
            for _ in range(60):
                item, swap = fresh(n), n // 9
                window = item.copy()
                window[:swap] = fresh(swap)
                if kind == 1:
                    window = item[: -(-4 * n // 5)]
                elif kind == 2:
                    item[:swap], window[:swap] = item[0], window[0]
                elif kind == 3:
                    item[swap:] = window[swap:] = item[-1]
                assert D.similarity(window, item) >= 0.8
                a, b = (D.window_prints(v, np.zeros(1, np.int64), len(v)) for v in (item, window))
                assert np.bitwise_count(a ^ b).sum() <= D.RADIUS


def test_one_changed_word_in_the_middle_is_found(llm, docs):
    items, rows = [], []
    for k in range(400):
        size = (49, 50, 52, 56)[k % 4]
        parts = [f"i{k}w{j}" for j in range(size)]
        items.append((k, " ".join(parts)))
        parts[size // 2] = "other"
        rows.append((k, " ".join(["before"] * 30 + parts + ["after"] * 30)))
    found = {(r["id"], r["item"]) for r in run(llm, docs(rows), items).collect()}
    # 49 words have 45 shingles, 40 of them shared: 40 of 50 is exactly 0.8.
    assert found == {(k, k) for k in range(400)}
