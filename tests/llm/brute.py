"""Plain versions of what the operators compute."""

from __future__ import annotations

import re
from collections import Counter

import xxhash

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text: str | None, lower: bool = False) -> list[str]:
    text = text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER) if lower else text)


def shingles(text: str | None, size: int) -> list[str]:
    parts = words(text, True)
    return [" ".join(parts[k : k + size]) for k in range(max(1, len(parts) - size + 1))] if parts else []


def fingerprint(text: str | None, size: int = 4) -> int:
    values = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, size)]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def components(count: int, edges) -> list[int]:
    parent = list(range(count))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(count)]


def jaccard(a: list[str], b: list[str]) -> float:
    a, b = Counter(a), Counter(b)
    return sum((a & b).values()) / max(1, sum((a | b).values()))
