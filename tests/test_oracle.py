"""Every query of the planner library against its DuckDB SQL on the smallest tables."""

import pytest

import __spark_entry__ as E
from slotplan.plans import catalog
from tests.conftest import SF_SMALL
from tools.check_oracle import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF_SMALL)
    assert res.get("ok") is True, res


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "best_xp_recipe" in df.columns
