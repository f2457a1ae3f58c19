"""Every registered query runs end to end on the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from conftest import SF001
from lodestar.plans.catalog import ORACLES, QUERIES

NAMES = sorted(QUERIES)   # the other subpackage's queries have tests of their own


def test_every_query_has_docs_and_most_have_oracles():
    qs, oracles = QUERIES, ORACLES
    assert set(qs) <= set(E.queries()) and set(oracles) <= set(E.oracle_sql())
    assert set(oracles) <= set(qs)
    assert set(qs) == set(oracles)
    for fn in qs.values():
        assert fn.__doc__, fn.__name__


@pytest.mark.parametrize("name", NAMES)
def test_query_runs_on_smallest_scale(spark, name):
    df = E.queries()[name](spark, SF001)
    cols = df.columns
    rows = df.collect()
    assert len(cols) == len(set(cols))
    assert all(len(r) == len(cols) for r in rows)


def test_entry_returns_top_twenty(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["id", "rank", "line"]
    assert 0 < len(rows) <= 20
    assert [r["rank"] for r in rows] == sorted((r["rank"] for r in rows), reverse=True)
