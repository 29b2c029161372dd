"""Every registered query against its SQL twin on the smallest tables.

Streams and whole jobs take long and are covered by their own tests, so they are
compared only when ``STOCKFLOW_ALL_QUERIES`` is set.
"""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry
from stockflow.oracle import ORACLE
from stockflow.queries import QUERIES
from tests.compare import difference

SF = "/root/testdata/sf0.001"
LONG = ("stream_", "merge_", "gold_job", "mart_job")
NAMES = [
    name
    for name in QUERIES
    if os.getenv("STOCKFLOW_ALL_QUERIES") or not name.startswith(LONG)
]


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


def test_the_flagship_query_has_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql_twin(spark, name):
    assert difference(QUERIES[name](spark, SF), SF, ORACLE[name]) is None
