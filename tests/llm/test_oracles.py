"""Corpus queries against their DuckDB SQL on the smallest tables."""

import pytest

from slotplan.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tools.check_oracle import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    res = compare(spark, duck(SF_SMALL), name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert res.get("ok") is True, res
