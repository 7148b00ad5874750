"""Every registered query: against its SQL, or that it runs and gives rows."""

from __future__ import annotations

import pytest

from tessaline.plans import corpus, markup  # noqa: F401  register their queries
from tessaline.plans.registry import ORACLES, QUERIES

from .conftest import SMALL, compare, duck


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    if name in ORACLES:
        compare(got, duck(SMALL).sql(ORACLES[name]).df())
    else:
        assert len(got) and len(got.columns) == len(set(got.columns))


def test_entry_points_without_training_operators(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_scans_are_pruned(spark):
    plan = QUERIES["catalogue_counts"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan.split("ReadSchema")[1].split(">")[0]
    plan = QUERIES["lang_filter"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(lang" in plan
