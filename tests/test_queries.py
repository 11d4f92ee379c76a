"""Every registered query against its SQL twin."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry_point
from tickloom.plans.oracle import ORACLE
from tickloom.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, con, sf_dir, name):
    found = compare.differences(spark, con, QUERIES[name], ORACLE[name], sf_dir)
    assert not found, found


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry_ranks_by_volatility(spark):
    rows = entry_point.entry(spark).collect()
    widths = [r.volatility_pct for r in rows]
    assert widths == sorted(widths, reverse=True) and len(rows) == 5
