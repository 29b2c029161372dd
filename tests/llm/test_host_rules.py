from __future__ import annotations

import re
from collections import Counter

from stockflow.llm import host_rules as H
from tests.llm import brute
from tests.llm.conftest import EDGES


def measures(text):
    parts = brute.words(text)
    windows = Counter(tuple(parts[k : k + 3]) for k in range(len(parts) - 2))
    inside = {k + d for k in range(len(parts) - 2) if windows[tuple(parts[k : k + 3])] > 1 for d in range(3)}
    lines = [line for line in (text or "").split("\n") if brute.words(line)]
    return (
        len(parts), sum(map(len, parts)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(inside),
    )


def columns(row):
    return (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"])


def test_edge_rows_match_brute_force(docs):
    rows = [*EDGES, (7, "a b c a b c d", "a"), (8, "x\nx\n\n \ny\nx", "b"), (9, "a a a a", "b"), (10, "<a|b> # & $%*", "a")]
    found = H.judged(docs(rows)).collect()
    assert Counter((r["id"], columns(r)) for r in found) == Counter((i, measures(t)) for i, t, _ in rows)
    for row in found:
        failed = row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"]
        assert row["base_failed"] == failed and (row["kept"] <= (not failed))


def test_documents_match_brute_force(llm):
    table = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = {r["id"]: columns(r) for r in H.judged(table).collect()}
    assert found == {r["doc_id"]: measures(r["text"]) for r in table.collect()}


def test_a_host_of_failures_takes_its_good_documents_along(docs):
    good = " ".join(f"w{k}" for k in range(80))
    rows = [(k, good, "fine") for k in range(40)] + [(100 + k, "short", "bad") for k in range(40)]
    rows += [(200, good, "bad"), (300, "short", "fine"), (400, good, None)]
    found = {r["id"]: r["kept"] for r in H.judged(docs(rows)).collect()}
    assert found[0] and found[400] and not found[200] and not found[300]
    table = docs(rows)
    kept = H.keep_good(table)
    assert kept.columns == table.columns
    assert {r["doc_id"] for r in kept.collect()} == {k for k, v in found.items() if v}


def test_a_small_host_is_shrunk_towards_the_rest(docs):
    good = " ".join(f"w{k}" for k in range(80))
    rows = [(100 * h + k, good, f"h{h}") for h in range(10) for k in range(50)] + [(9999, "short", "tiny"), (9998, good, "tiny")]
    rates = {r["host"]: r["host_rate"] for r in H.judged(docs(rows)).collect()}
    assert rates["tiny"] < 0.5 and rates["h1"] < rates["tiny"]


def test_empty_tables(docs):
    assert H.judged(docs([])).collect() == [] and H.keep_good(docs([])).collect() == []


def test_rows_without_an_id_are_judged_alone(docs):
    good = " ".join(f"w{k}" for k in range(80))
    assert [r["text"] for r in H.keep_good(docs([(None, good, "a"), (None, "short", "a"), (None, None, "a")])).collect()] == [good]


def test_rows_of_one_id_are_judged_each(docs):
    good = " ".join(f"w{k}" for k in range(80))
    rows = [(7, good, "a"), (7, "short", "a"), (7, None, "a"), (8, good, None), (9, good, "a"), (9, good, "a"), (9, good + " more", "a")]
    kept = H.keep_good(docs(rows)).collect()
    assert sorted((r["doc_id"], len(r["text"].split())) for r in kept) == [(7, 80), (8, 80), (9, 80), (9, 80), (9, 81)]
