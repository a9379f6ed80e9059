"""Every query that has SQL gives the rows of that SQL."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from contrail.registry import ORACLES, QUERIES
from tests.oracle import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
MAY_BE_EMPTY = {"lookup_duplicate_codes"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_matches_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    rows, differences = compare(df, duck, entry_points.oracle_sql()[name])
    assert not differences
    assert rows > 0 or name in MAY_BE_EMPTY


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() == 40
