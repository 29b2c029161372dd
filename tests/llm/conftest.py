from __future__ import annotations

import pytest

from stockflow.llm.ship import ship

# Names that operators use inside, as further columns of their input.
CLASHING = (
    "id host size n vertex fp wide kind shard block row of key copies mark at rate target "
    "component root kept spans item page page_id url html _lost word m hash found"
).split()


@pytest.fixture(scope="session")
def llm(spark):
    ship(spark)
    return spark


@pytest.fixture
def docs(llm):
    """Documents from (doc_id, text[, source]), with clashing further columns."""

    def make(rows, partitions=3):
        schema = "doc_id bigint, text string, source string, lang string, " + ", ".join(
            f"`{name}` string" for name in CLASHING
        )
        full = [(*row, *["src0"][len(row) - 2 :])[:3] + ("en",) + ("x",) * len(CLASHING) for row in rows]
        return llm.createDataFrame(full, schema).repartition(partitions)

    return make


@pytest.fixture
def pages(llm):
    def make(rows):
        schema = "page_id bigint, url string, html string, id string, row string, host string, key string"
        return llm.createDataFrame([(*row, "a", "b", "c", "d") for row in rows], schema)

    return make


EDGES = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \t\n", None),
    (4, "One two three four five six seven.", "b"),
    (4, "One two three four five six seven.", "b"),
    (None, "one two three four five six seven.", "a"),
    (5, "word " * 30_000, "a"),
    (6, "é ü 漢字 😀", None),
]


@pytest.fixture
def edges():
    return EDGES
