from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from stockflow.llm import packing as P
from stockflow.llm import words as W


def plain(lengths, capacity):
    rows = []
    for need in sorted(lengths, reverse=True):
        fits = [(free, k) for k, free in enumerate(rows) if free >= need]
        if fits:
            rows[min(fits)[1]] -= need
        else:
            rows.append(capacity - need)
    return sorted(rows)


@pytest.mark.parametrize("capacity", [1, 7, 64, 100])
def test_best_fit_matches_a_plain_search(capacity):
    rng = np.random.default_rng(capacity)
    for _ in range(20):
        lengths = rng.integers(1, capacity + 1, 150)
        row, _ = P.best_fit(lengths, capacity)
        assert sorted((capacity - np.bincount(row, lengths)).astype(int).tolist()) == plain(lengths.tolist(), capacity)


TEXTS = ["", " ", "a　 b  c", "  lead trail  ", "x\n\n y\t\tz \n", "don't 12,3 é", "word " * 500, "a b a b a b"]


def test_words_encoded_once_give_the_texts_tokens(llm):
    tok = P.Tokenizer(P.TOKENIZER)
    texts = TEXTS + [r["text"] for r in llm.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for one, text in zip(tok.encode([t.encode() for t in texts]), texts, strict=True):
        assert one.tolist() == [*tok.encoding.encode_ordinary(text), P.END]


def test_files_hold_every_token_once(llm, docs, edges, tmp_path):
    rows = [*edges, *[(100 + k, t, "a") for k, t in enumerate(TEXTS)]]
    folder = str(tmp_path / "packed")
    found = P.write_packed(docs(rows), folder, length=64).collect()
    tok = P.Tokenizer(P.TOKENIZER)
    files = {name: (ids, cu, pos) for name, ids, cu, pos in P.read_packed(folder, 64)}
    parts = defaultdict(list)
    for row in found:
        ids, _, pos = files[row["file"]]
        bounds = row["cumulative"]
        assert bounds[-1] == row["n_tokens"] and row["resets"] == bounds[:-1]
        assert (ids[row["row"], bounds[-1] :] == P.END).all()
        for k, (key, first) in enumerate(zip(row["doc_ids"], row["first_tokens"], strict=True)):
            piece = ids[row["row"], bounds[k] : bounds[k + 1]]
            assert (pos[row["row"], bounds[k] : bounds[k + 1]] == np.arange(len(piece))).all()
            parts[key].append((first, piece.tolist()))
    for name, (ids, cu, _) in files.items():
        mine = sorted((r for r in found if r["file"] == name), key=lambda r: r["row"])
        assert cu.tolist() == [c for r in mine for c in r["cumulative"]] and len(ids) == len(mine)
    for key in {row[0] for row in rows}:
        texts = [row[1] or "" for row in rows if row[0] == key]
        want = [*tok.encoding.encode_ordinary(texts[0]), P.END]
        for copy in range(len(texts)):
            got = sorted(parts[key])[copy :: len(texts)]
            assert [t for _, piece in got for t in piece] == want


def test_an_empty_table_has_no_rows(docs):
    assert P.write_packed(docs([])).collect() == []


def test_slices_cover_all_rows():
    sizes = [5, 0, 0, 100, 3, 3, 3, 0]
    cuts = list(W.slices(sizes, 8))
    assert [k for low, high in cuts for k in range(low, high)] == list(range(len(sizes)))
    assert list(W.slices([], 8)) == []
