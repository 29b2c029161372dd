from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from stockflow.llm import lm
from stockflow.llm.elias_fano import EliasFano, Trie
from tests.llm import brute


@pytest.mark.parametrize("size,top", [(0, 1), (1, 5), (10, 3), (1000, 10**6), (3000, 2**60), (3000, 100)])
def test_sequences_match_plain_search(size, top):
    rng = np.random.default_rng(size)
    values = np.sort(rng.integers(0, top, size, dtype=np.uint64))
    sequence = EliasFano.of(values)
    assert (sequence[np.arange(size)] == values).all()
    if size:
        queries = np.concatenate([values, rng.integers(0, 2 * top, 500, dtype=np.uint64)])
        index, equal = sequence.successor(queries)
        assert (index == np.searchsorted(values, queries)).all()
        assert (equal == np.isin(queries, values)).all()


@pytest.mark.parametrize("order", [2, 3, 4])
def test_tries_match_a_dictionary(order):
    rng = np.random.default_rng(order)
    grams = np.unique(rng.integers(1, 20, (1500, order)), axis=0)
    codes = rng.integers(0, 65535, len(grams))
    contexts = np.unique(grams[:, :-1], axis=0).tolist()
    trie = Trie.load(np.frombuffer(Trie.of(grams, codes, np.arange(len(contexts))).to_bytes(), np.uint64))
    queries = rng.integers(1, 25, (3000, order))
    context, at = trie.find(queries)
    known = {tuple(g): k for k, g in enumerate(grams.tolist())}
    above = {tuple(g): k for k, g in enumerate(contexts)}
    assert at.tolist() == [known.get(tuple(q), -1) for q in queries.tolist()]
    assert context.tolist() == [above.get(tuple(q[:-1]), -1) for q in queries.tolist()]
    assert (trie.codes[at[at >= 0]] == codes[at[at >= 0]]).all()


def expected(rows):
    texts = [[*brute.words(text, True), None] for _, text, *_ in rows]
    held = [zlib.crc32(("" if key is None else str(key)).encode()) % 5 == 1 for key, *_ in rows]
    count, pairs = Counter(), Counter()
    for words, out in zip(texts, held, strict=True):
        if not out:
            count.update(words)
            pairs.update(zip([None, *words], words, strict=False))
    follow, total, distinct = Counter(a for a, _ in pairs), sum(count.values()), len(count)
    result = []
    for (key, *_), words, out in zip(rows, texts, held, strict=True):
        base = [(count[w] + 0.5) / (total + 0.5 * (distinct + 1)) for w in words]
        score = 0.0
        for a, b, p in zip([None, *words], words, base, strict=False):
            if count[a]:
                p = max(pairs[a, b] - 0.75, 0) / count[a] + 0.75 * follow[a] / count[a] * p
            score += math.log10(p)
        result.append((key, out, len(words), sum(count[w] > 0 for w in words), total, sum(map(math.log10, base)), score))
    return result


def close(found, want):
    key = lambda r: (str(r[0]), r[2], r[3], round(r[5], 3))
    found, want = sorted(map(tuple, found), key=key), sorted(want, key=key)
    assert [r[:5] for r in found] == [r[:5] for r in want]
    for a, b in zip(found, want, strict=True):
        assert math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9)
        assert abs(a[6] - b[6]) <= 3e-4 * a[2]


def test_edge_rows_match_brute_force(docs, edges):
    rows = [*edges, *[(k, f"a b c w{k} a b", "x") for k in range(100, 140)]]
    close(lm.score(docs(rows)).collect(), expected(rows))


def test_documents_match_brute_force_and_beat_the_base(llm):
    table = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = lm.score(table).collect()
    close(found, expected([(r["doc_id"], r["text"]) for r in table.collect()]))
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_small_blocks_change_nothing(docs, edges, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 10)
    rows = [*edges, (50, "one two three", "x"), (51, "one two four", "x")]
    close(lm.score(docs(rows)).collect(), expected(rows))


def test_a_context_cut_into_several_tries_still_sums_to_one():
    rng = np.random.default_rng(0)
    words = np.arange(1, 4001, dtype=np.uint64)
    cut = lm._cut_of(words)
    count = rng.integers(1, 50, len(words))
    sums = np.bincount(cut, count, lm.CUTS).astype(np.int64)
    model = lm.Model(sums, np.bincount(cut, minlength=lm.CUTS), 4)
    seen = np.full(len(words), float(lm.TRIE_TOKENS * 2))
    power = model.cuts(seen)
    assert power[0] == 2
    node = model.nodes(np.full(len(words), 9, np.uint64), power, words)
    train = np.where(np.arange(len(words)) % 3 == 0, lm.TRIE_TOKENS * 2 / 1334, 0).astype(np.int64)
    seen[:] = train.sum()
    code = np.round(-model.base(count) * lm.STEP).astype(np.uint16)
    trie = lm.trie_of(node, words, train, code, seen, model)
    total = (10 ** lm.scored(trie, node, words, code, seen, model)).sum()
    assert abs(total - 1) < 0.002


def test_all_held_out_and_empty(docs):
    held = next(k for k in range(50) if lm.held_out(k))
    row = lm.score(docs([(held, "a b", "x")])).collect()[0]
    assert (row["train_tokens"], row["n_known"], row["score"], row["base_score"]) == (0, 0, 0.0, 0.0)
    assert lm.score(docs([])).collect() == []
