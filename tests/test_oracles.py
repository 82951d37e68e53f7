"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import pytest
from oracle_check import connect, difference

from __spark_entry__ import entry, oracle_sql, queries
from freightlens.registered import QUERIES
from oracles import ORACLES as TEXTS


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


def test_every_query_has_sql():
    assert set(QUERIES) == set(TEXTS)
    assert set(QUERIES) <= set(queries()) and set(TEXTS) <= set(oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_same_result(spark, folder, duck, name):
    assert difference(QUERIES[name](spark, folder), duck, TEXTS[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0
