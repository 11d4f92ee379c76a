"""Registered queries against their SQL twins."""

from __future__ import annotations

import compare
import pytest

from tickloom.llm.registry import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, sf_dir, name):
    found = compare.differences(spark, compare.connect(sf_dir), QUERIES[name], ORACLE[name], sf_dir)
    assert not found, found


def test_registered_names():
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in QUERIES} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}
