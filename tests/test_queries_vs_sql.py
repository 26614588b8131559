"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare  # noqa: E402

import __spark_entry__ as entry_module  # noqa: E402

QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()
#: a page that lies behind the end of the smallest tables
EMPTY_ON_SMALLEST = {"sort02_keyset_page"}


@pytest.fixture(scope="module")
def con(sf):
    return compare.connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(name, spark, con, sf):
    text, _ = compare.check(name, spark, con, sf, QUERIES, ORACLES)
    assert text.startswith("ok") or (name in EMPTY_ON_SMALLEST and text.startswith("EMPTY")), text
    assert "  types [" not in text, text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(name, spark, sf):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry_gives_rows(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
