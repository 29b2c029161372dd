from __future__ import annotations

from collections import Counter, defaultdict

from stockflow.llm import site_lines as L
from tests.llm import brute


def expected(rows, ratio, least):
    pages, seen = Counter(), defaultdict(Counter)
    for _, text, host in rows:
        pages[host] += 1
        for line in {" ".join(brute.words(line)) for line in (text or "").split("\n")}:
            seen[host][line] += 1
    out = []
    for key, text, host in rows:
        lines = (text or "").split("\n")
        kept = [
            line
            for line in lines
            if not (c := " ".join(brute.words(line)))
            or seen[host][c] < least
            or seen[host][c] <= ratio * pages[host]
        ]
        out.append((key, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return Counter(out)


def test_rows_match_brute_force(docs, edges):
    rows = [*edges]
    for k in range(30):
        rows.append((100 + k, f"menu  one\nbody {k}\n\nfooter\tend\nmenu one", "big"))
        rows.append((200 + k, f"text {k}\n" + ("rare" if k < 2 else f"own {k}"), None))
    found = L.without_boilerplate(docs(rows), max_ratio=0.2)
    got = Counter((r["id"], r["text"], r["n_lines"], r["n_dropped"]) for r in found.collect())
    assert got == expected(rows, 0.2, 3)


def test_empty_table(docs):
    assert L.without_boilerplate(docs([])).collect() == []
