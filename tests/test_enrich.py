"""Joins with the lookups: unmatched and repeated codes, and the choice of the join."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from contrail.operators.clean import clean
from contrail.operators.enrich import Lookups, attach_carrier, broadcast_limit, enrich
from contrail.operators.lookups import duplicate_codes, profile_lookups, unmatched_codes
from tests.trips import airports, carriers, raw_trips, rows_of


def plan_of(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_unmatched_trip_keeps_its_row(spark):
    trips = clean(raw_trips(spark, {}, {"airline": "ZZ", "origin_airport": None}))
    lookups = Lookups.measure(carriers(spark), airports(spark))
    out = {r.airline: r for r in enrich(trips, lookups).collect()}
    assert out["AA"].airline_name == "First Air"
    assert (out["AA"].origin_city, out["AA"].destination_city) == ("Seaton", "Clayton")
    assert round(out["AA"].origin_lat, 1) == 47.4
    assert out["ZZ"].airline_name is None and out["ZZ"].origin_city is None
    assert out["ZZ"].destination_state == "NC"


def test_column_order_is_that_of_joins_on_the_key(spark):
    lookups = Lookups.measure(carriers(spark), airports(spark))
    columns = enrich(clean(raw_trips(spark, {})), lookups).columns
    assert columns[:4] == ["destination_airport", "origin_airport", "airline", "year"]
    assert columns[-9:] == [
        "airline_name", "origin_airport_name", "origin_city", "origin_state", "origin_lat",
        "origin_lon", "destination_airport_name", "destination_city", "destination_state",
    ]


def test_repeated_code_repeats_the_trip(spark):
    twice = carriers(spark, ("AA", "Old Air"), ("AA", "New Air"), (None, "x"), (None, "y"))
    lookups = Lookups.measure(twice, airports(spark))
    assert lookups.carriers_profile.max_copies == 2 and not lookups.unique
    assert enrich(clean(raw_trips(spark, {})), lookups).count() == 2


def test_null_codes_do_not_count_as_repeated(spark):
    lookups = Lookups.measure(carriers(spark, (None, "x"), (None, "y")), airports(spark))
    assert lookups.unique


def test_profile_of_empty_lookup(spark):
    empty = carriers(spark).filter("false")
    profile = profile_lookups({"carriers": empty})["carriers"]
    assert (profile.rows, profile.bytes, profile.unique) == (0, 0, True)


def test_profile_measures_bytes(spark):
    small = profile_lookups({"c": carriers(spark, ("AA", "x"))})["c"]
    large = profile_lookups({"c": carriers(spark, ("AA", "x" * 1000))})["c"]
    assert large.bytes - small.bytes == 999


def test_quality_reports(spark):
    trips = clean(raw_trips(spark, {}, {"airline": "ZZ"}, {"airline": "ZZ"}, {"airline": None}))
    found = unmatched_codes(trips, "airline", carriers(spark))
    assert {(r.iata_code, r.trips) for r in found.collect()} == {("ZZ", 2), (None, 1)}
    twice = duplicate_codes(carriers(spark, ("AA", "1"), ("AA", "2"), ("BB", "3")))
    assert [tuple(r) for r in twice.collect()] == [("AA", 2)]


def test_broadcast_limit_reads_the_session(spark, conf):
    for text, size in (("10485760b", 10 << 20), ("3MB", 3 << 20), ("64k", 64 << 10), ("-1", -1)):
        conf(spark__sql__autoBroadcastJoinThreshold=text)
        assert broadcast_limit(spark) == size


def test_small_lookups_are_broadcast(spark):
    lookups = Lookups.measure(carriers(spark), airports(spark))
    plan = plan_of(enrich(clean(raw_trips(spark, {})), lookups))
    assert plan.count("BroadcastHashJoin") == 3
    assert "SortMergeJoin" not in plan


def test_lookup_beyond_the_limit_is_shuffled(spark, conf):
    trips = clean(raw_trips(spark, {}, {"airline": "ZZ"}, {"airline": None}))
    lookups = Lookups.measure(carriers(spark), airports(spark))
    expected = rows_of(enrich(trips, lookups))
    conf(spark__sql__autoBroadcastJoinThreshold="100b")
    shuffled = enrich(trips, lookups)
    assert "BroadcastHashJoin" not in plan_of(shuffled)
    assert plan_of(shuffled).count("SortMergeJoin") == 3
    assert rows_of(shuffled) == expected


def test_hot_code_is_split_over_tasks(spark, conf):
    """Half of the trips carry one code and a sixth carry none; their partitions are split."""
    code = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 3 == 0, None)
    trips = spark.range(0, 400_000, numPartitions=8).select(
        code.otherwise((F.col("id") % 97).cast("string")).alias("airline"),
        F.repeat(F.sha2(F.col("id").cast("string"), 256), 2).alias("payload"),
    )
    names = carriers(spark, ("hot", "Hot Air"), *[(str(i), f"Air {i}") for i in range(97)])
    lookups = Lookups.measure(names, airports(spark))
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1MB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="1MB",
    )
    joined = attach_carrier(trips, lookups)
    counts = joined.groupBy("airline_name").agg(F.count("*").alias("count"), F.max("payload"))
    seen = {r.airline_name: r["count"] for r in counts.collect()}
    assert "skew=true" in plan_of(counts)
    assert seen["Hot Air"] == 200_000 and sum(seen.values()) == 400_000
    assert seen[None] == trips.filter("airline IS NULL").count()
