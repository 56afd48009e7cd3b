"""Every query of this package's own operators against DuckDB, on the smallest tables."""

from __future__ import annotations

from functools import lru_cache

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks import queries as definitions
from checks.compare import difference, duck
from checks.oracles import oracle_sql as own_sql
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
# The gate that passes has no rows to show; its failing form is a query of its own.
EMPTY = {"dq_orphan_rate_gate"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.fixture(scope="module", autouse=True)
def one_chain():
    """The queries over published tables share one pair of runs here."""
    patch = pytest.MonkeyPatch()
    patch.setattr(definitions, "published", lru_cache(definitions.published))
    yield
    patch.undo()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    found = difference(QUERIES[name](spark, SF), con, own_sql()[name])
    assert found is None or (name in EMPTY and found == "both empty")


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(own_sql())
    assert set(QUERIES) <= set(queries()) and set(own_sql()) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    df = entry(spark)
    assert df.columns[:2] == ["order_date", "country"] and df.count() > 0
