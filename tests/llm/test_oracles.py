"""The operators that SQL can express, against that SQL in DuckDB."""

from __future__ import annotations

import pytest
from contrail.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    n, differences = compare(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name])
    assert n >= 1000 and not differences
