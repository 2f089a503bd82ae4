"""Every query that has a SQL counterpart gives the same rows."""

from __future__ import annotations

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries
from tillroll.plans.forecast import ForecastSettings
from tillroll.registry import queries as registry
from tillroll.registry.oracles import all_oracles
from tillroll.registry.queries import all_queries


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_registered_names():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_same_rows(spark, sf_dir, con, name, monkeypatch):
    few = ForecastSettings(trees=5, depth=6, labelled_rows=1000, partitions=2)
    monkeypatch.setattr(registry, "FORECAST", few)
    assert difference(all_queries()[name](spark, sf_dir), con, all_oracles()[name]) is None
