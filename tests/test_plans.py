"""Physical plans: what is shuffled, joined, pushed down and read."""

from __future__ import annotations

import io
import re
from contextlib import redirect_stdout

import pytest

from contrail import fixture
from contrail.operators.aggregates import FEATURE_TABLES, aggregate_together
from contrail.operators.clean import clean, select_quarter
from contrail.operators.enrich import Lookups, enrich
from contrail.operators.features import add_departure_hour, engineer_features
from contrail.plans.feature_tables import feature_table
from contrail.sources.files import read_trips
from tests.trips import airports, carriers, raw_trips

SF_DIR = "/root/testdata/sf0.001"


def explained(df, mode="formatted") -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.fixture(scope="module")
def parquet(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "trips")
    fixture.raw_trips(spark, SF_DIR).write.parquet(path)
    return path


@pytest.fixture(scope="module")
def csv(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "trips")
    fixture.raw_trips(spark, SF_DIR).write.option("header", True).csv(path)
    return path


@pytest.fixture(scope="module")
def lookups(spark):
    return Lookups.measure(carriers(spark), airports(spark))


def columns_read(plan: str) -> set[str]:
    schema = re.search(r"ReadSchema: struct<(.*)>", plan).group(1)
    return {field.split(":")[0].lower() for field in schema.split(",")}


@pytest.mark.parametrize("name", FEATURE_TABLES)
def test_one_shuffle_and_no_join_below_it(spark, parquet, lookups, name):
    trips = clean(spark.read.parquet(parquet)).transform(add_departure_hour)
    plan = explained(feature_table(trips, lookups, name), "simple")
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in plan
    below = plan[plan.index("Exchange hashpartitioning"):]
    below = below.split("+- BroadcastExchange")[0]
    assert "Join" not in below and "partial_count" in below


def test_together_has_one_scan_and_one_shuffle(spark, parquet):
    trips = clean(spark.read.parquet(parquet)).transform(add_departure_hour)
    codes = {name: table.codes for name, table in FEATURE_TABLES.items()}
    plan = explained(aggregate_together(trips, codes), "simple")
    assert plan.count("FileScan") == plan.count("Exchange") == 1


def test_hourly_table_reads_its_columns_only(spark, parquet, lookups):
    trips = clean(spark.read.parquet(parquet)).transform(add_departure_hour)
    plan = explained(feature_table(trips, lookups, "hourly_features"))
    assert columns_read(plan) == {
        "month", "day_of_week", "scheduled_departure", "arrival_delay", "departure_delay",
        "cancelled",
    }


@pytest.mark.parametrize("source", ["csv", "parquet"])
def test_cancelled_filter_reaches_the_scan(spark, csv, parquet, source):
    raw = read_trips(spark, csv) if source == "csv" else spark.read.parquet(parquet)
    pushed = re.search(r"PushedFilters: \[(.*)\]", explained(clean(raw))).group(1)
    assert "EqualTo(CANCELLED,0)" in pushed


def test_delay_filters_reach_a_typed_scan(spark, tmp_path):
    path = str(tmp_path / "processed")
    clean(raw_trips(spark, {})).write.parquet(path)
    pushed = re.search(r"PushedFilters: \[(.*)\]", explained(clean(spark.read.parquet(path)))).group(1)
    assert "IsNotNull(arrival_delay)" in pushed and "IsNotNull(departure_delay)" in pushed


def test_quarter_prunes_month_partitions(spark, tmp_path):
    path = str(tmp_path / "lake")
    raw_trips(spark, {}, {"month": "5"}).write.partitionBy("year", "month").parquet(path)
    plan = explained(spark.read.parquet(path).transform(clean).transform(select_quarter, "Q2"))
    assert "month" in re.search(r"PartitionFilters: \[(.*)\]", plan).group(1)


def test_enrichment_is_one_generated_pass(spark, parquet, lookups, conf):
    """No shuffle, no row-wise Python, and small enough for the JVM to compile (8000 bytes)."""
    df = engineer_features(enrich(clean(spark.read.parquet(parquet)), lookups))
    plan = explained(df, "simple")
    assert plan.count("BroadcastHashJoin") == 3
    assert "Exchange hashpartitioning" not in plan and "Python" not in plan
    # Adaptive plans generate code only when they run.
    conf(spark__sql__adaptive__enabled="false")
    static = engineer_features(enrich(clean(spark.read.parquet(parquet)), lookups))
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", explained(static, "codegen"))
    assert sizes and max(int(s) for s in sizes) < 8000
