from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockflow.llm import queries
from stockflow.llm.word_runs import Catchers, find
from tests.llm.brute import words


def runs(sequence, least=6, power=4):
    """Every maximal stretch of each period, smallest period first."""
    found, n = {}, len(sequence)
    for period in range(1, n // power + 1):
        start = None
        for at in range(n - period + 1):
            equal = at + period < n and sequence[at] == sequence[at + period]
            if equal and start is None:
                start = at
            if not equal and start is not None:
                length = at + period - start
                if length >= max(least, power * period):
                    found.setdefault((start, length), period)
                start = None
    return sorted((start, length, period) for (start, length), period in found.items())


def caught(sequence, cuts):
    catchers = Catchers()
    codes = np.array(sequence, np.uint64)
    for low, high in zip([0, *cuts], [*cuts, len(codes)], strict=True):
        catchers.append(codes[low:high])
    return sorted(zip(*(values.tolist() for values in catchers.runs()), strict=True))


def sequences():
    rng = random.Random(7)
    yield []
    yield [3] * 500
    yield [1, 2] * 100 + [3] + [1, 2] * 100
    thue = [0]
    while len(thue) < 512:
        thue += [1 - x for x in thue]
    yield thue
    yield thue[:64] * 5 + thue
    fibonacci = ([0], [0, 1])
    while len(fibonacci[1]) < 600:
        fibonacci = (fibonacci[1], fibonacci[1] + fibonacci[0])
    yield fibonacci[1]
    for _ in range(60):
        out = []
        while len(out) < rng.randint(1, 400):
            unit = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randint(1, 40))]
            whole = unit * rng.randint(1, 6)
            out += whole[: rng.randint(1, len(whole))]
        yield out


def test_caught_runs_equal_brute_force():
    for sequence in sequences():
        assert caught(sequence, []) == runs(sequence)


def test_the_cuts_do_not_matter():
    rng = random.Random(3)
    for sequence in sequences():
        whole = runs(sequence)
        cuts = sorted(rng.randint(0, len(sequence)) for _ in range(rng.randint(0, 40)))
        assert caught(sequence, cuts) == whole
    every = [1, 2, 3] * 30 + [4] * 9
    assert caught(every, range(1, len(every))) == runs(every)


def test_a_square_is_reported_when_it_arrives():
    catchers = Catchers()
    reports = [catchers.append(np.array([word], np.uint64)) for word in [5, 6, 7, 8] * 5]
    first = next(at for at, found in enumerate(reports) if found)
    assert first < 12
    with pytest.raises(ValueError):
        Catchers(power=3)


def collapsed(sequence, found):
    lost = {at for start, length, period in found for at in range(start + period, start + length)}
    return " ".join(word for at, word in enumerate(sequence) if at not in lost)


def test_texts_equal_brute_force(docs, edges):
    rng = random.Random(1)
    rows = [*edges, (7, "a b c " * 9 + "d", "s"), (8, "x\x0by\x0cz w " * 7, "s"), (9, "　 é " * 8, "s")]
    rows = [row for row in rows if row[0] != 5] + [(5, "word " * 300, "a")]
    for at in range(60):
        unit = " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 30)))
        rows.append((20 + at, f"{unit} " * rng.randint(1, 7) + "end a a a a a a a", "s"))
    expected = sorted(
        (i is None, i or 0, len(w := words(t)), tuple(f := runs(w)), collapsed(w, f)) for i, t, *_ in rows
    )
    found = [
        (r["id"] is None, r["id"] or 0, r["n_words"], tuple(tuple(x) for x in r["runs"]), r["collapsed"])
        for r in find(docs(rows)).collect()
    ]
    assert sorted(found) == expected


def test_a_very_long_text_is_appended_in_slabs(docs):
    unit = " ".join(f"w{k}" for k in range(70_001))
    row = find(docs([(1, f"head {unit} {unit} {unit} {unit} {unit} w0 w1 tail", "s")])).first()
    assert [tuple(x) for x in row["runs"]] == [(1, 5 * 70_001 + 2, 70_001)]
    assert row["collapsed"] == f"head {unit} tail"


def planted(doc_id, text):
    w = words(text)
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_query_rows(llm, tmp_path):
    documents = llm.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 6000")
    documents = documents.unionByName(
        documents.limit(1).select(F.lit(10**6 + 7).alias("doc_id"), F.lit(None).cast("string").alias("text"), "lang", "source", "n_chars")
    )
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    expected = set()
    for row in documents.collect():
        w = planted(row["doc_id"], row["text"])
        found = runs(w)
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        milli = 1000 * best[1] // best[2] if found else None
        sha = [hashlib.sha256(t.encode()).hexdigest() for t in (listed, collapsed(w, found))]
        expected.add((row["doc_id"], len(found), *best, milli, *sha))
    result = queries.QUERIES["op12_word_runs"](llm, str(tmp_path))
    assert {kind for _, kind in result.dtypes} == {"bigint", "string"}
    assert {tuple(row) for row in result.collect()} == expected
    assert any(row[1] for row in expected)


def test_no_rows(docs):
    assert find(docs([])).collect() == []
