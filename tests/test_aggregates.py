"""Feature tables: their edge cases, and agreement of the three ways to build them."""

from __future__ import annotations

from datetime import UTC, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from contrail.operators.aggregates import FEATURE_TABLES, aggregate_features
from contrail.operators.clean import clean
from contrail.operators.enrich import Lookups, enrich
from contrail.operators.features import engineer_features
from contrail.plans.feature_tables import feature_groups, feature_table
from tests.trips import airports, carriers, raw_trips, rows_of


def prepared(spark, *changes):
    return engineer_features(clean(raw_trips(spark, *changes)))


def test_one_row_group_has_no_deviation(spark):
    lookups = Lookups.measure(carriers(spark), airports(spark))
    row = feature_table(prepared(spark, {}), lookups, "airline_features").first()
    assert row.std_arrival_delay is None and row.total_flights == 1
    assert row.avg_weather_delay_min is None, "a cause that nobody reported has no mean"


def test_cause_means_skip_nulls(spark):
    lookups = Lookups.measure(carriers(spark), airports(spark))
    trips = prepared(spark, {"weather_delay": "10"}, {}, {"weather_delay": "5"})
    row = feature_table(trips, lookups, "airline_features").first()
    assert row.avg_weather_delay_min == 7.5


def test_rate_and_rounding(spark):
    lookups = Lookups.measure(carriers(spark), airports(spark))
    trips = prepared(spark, {"arrival_delay": "16"}, {"arrival_delay": "1"}, {"arrival_delay": "2"})
    row = feature_table(trips, lookups, "airline_features").first()
    assert (row.delayed_flights, row.delay_rate_pct) == (1, 33.33)
    assert row.avg_arrival_delay_min == 6.33


def test_airport_rate_counts_late_arrivals(spark):
    lookups = Lookups.measure(carriers(spark), airports(spark))
    trips = prepared(spark, {"arrival_delay": "20", "departure_delay": "0"})
    row = feature_table(trips, lookups, "airport_features").first()
    assert (row.delayed_departures, row.departure_delay_rate_pct) == (1, 100.0)


def test_null_codes_are_groups_of_their_own(spark):
    lookups = Lookups.measure(carriers(spark), airports(spark))
    trips = prepared(
        spark, {}, {"origin_airport": None}, {"airline": None, "scheduled_departure": None}
    )
    tables = feature_groups(trips, lookups).tables()
    route = {r.origin_airport: r for r in tables["route_features"].collect()}
    assert route[None].route is None and route[None].destination_city == "Clayton"
    assert {r.airline for r in tables["airline_features"].collect()} == {"AA", None}
    assert {r.scheduled_departure_hour for r in tables["hourly_features"].collect()} == {9, None}


def test_output_columns(spark):
    lookups = Lookups.measure(carriers(spark), airports(spark))
    stamp = datetime(2015, 4, 1, tzinfo=UTC)
    for tables in (
        feature_groups(prepared(spark, {}), lookups).tables(stamp),
        aggregate_features(enrich(prepared(spark, {}), lookups), stamp),
    ):
        assert set(tables) == set(FEATURE_TABLES)
        for name, table in tables.items():
            shown = FEATURE_TABLES[name]
            assert table.columns == [*shown.keys, *shown.measures, "processed_at"]
            assert dict(table.dtypes)["processed_at"] == "timestamp"
            counts = [c for c, m in shown.measures.items() if m in ("trips", "delayed")]
            assert {dict(table.dtypes)[c] for c in counts} == {"bigint"}


UNIQUE = ("unique", (("AA", "First Air"), ("BB", "Second Air")), None)
REPEATED_CARRIER = ("carrier", (("AA", "First"), ("AA", "First"), ("AA", "Other"), ("BB", "B")), None)
REPEATED_AIRPORT = (
    "airport",
    (("AA", "First Air"),),
    (("SEA", "a", "Seaton", "WA", "1", "2"), ("SEA", "b", "Seaton", "WA", "1", "2")),
)


@pytest.mark.parametrize(
    ("label", "names", "places"), [UNIQUE, REPEATED_CARRIER, REPEATED_AIRPORT],
    ids=["unique", "repeated carrier", "repeated airport"],
)
def test_all_plans_agree_with_joining_first(spark, label, names, places):
    """Joining first and grouping the joined trips is the definition; the others must equal it."""
    changes = [
        {
            "airline": a, "origin_airport": o, "destination_airport": d, "month": m,
            "arrival_delay": str(i * 7 % 40 - 10), "weather_delay": None if i % 3 else str(i),
            "taxi_out": str(i), "scheduled_departure": f"{i % 24:02d}15", "day_of_week": str(i % 7),
        }
        for i, (a, o, d, m) in enumerate(
            (a, o, d, m)
            for a in ("AA", "BB", "ZZ", None)
            for o in ("SEA", None)
            for d in ("CLT", "SEA", "XXX")
            for m in ("1", "5", "12")
        )
    ]
    trips = prepared(spark, *changes)
    lookups = Lookups.measure(carriers(spark, *names), airports(spark, *(places or ())))
    assert lookups.unique == (label == "unique")
    enriched = enrich(trips, lookups)
    expected = {name: rows_of(t) for name, t in aggregate_features(enriched).items()}
    for source in (trips, enriched):
        groups = feature_groups(source, lookups)
        assert {name: rows_of(t) for name, t in groups.tables().items()} == expected
        single = {name: rows_of(feature_table(source, lookups, name)) for name in FEATURE_TABLES}
        assert single == expected
        sizes = {name: len(rows) for name, rows in expected.items() if rows}
        assert groups.sizes() == (sizes, enriched.count())


trip = st.fixed_dictionaries(
    {
        "airline": st.sampled_from(["AA", "BB", "ZZ", None]),
        "origin_airport": st.sampled_from(["SEA", "CLT", "XXX", None]),
        "destination_airport": st.sampled_from(["SEA", "CLT", None]),
        "month": st.sampled_from(["1", "4", "7", "10", "13", None]),
        "scheduled_departure": st.sampled_from(["0005", "1200", "2400", "x", None]),
        "arrival_delay": st.sampled_from(["-5", "15", "15.5", "90", "NaN", None]),
        "cancelled": st.sampled_from(["0", "1"]),
    }
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(trip, min_size=1, max_size=30))
def test_invariants(spark, changes):
    trips = prepared(spark, *changes)
    lookups = Lookups.measure(carriers(spark), airports(spark))
    total = trips.count()
    for name, table in feature_groups(trips, lookups).tables().items():
        count, delayed, rate = (
            next(c for c, m in FEATURE_TABLES[name].measures.items() if m == measure)
            for measure in ("trips", "delayed", "delay_rate")
        )
        rows = table.collect()
        assert sum(r[count] for r in rows) == total
        assert all(0 <= r[delayed] <= r[count] and 0 <= r[rate] <= 100 for r in rows)
