"""Edge rows of cleaning and row-level features, under ANSI mode as it ships."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from contrail.functions.casts import as_int
from contrail.functions.trips import in_quarter, quarter_label
from contrail.operators.clean import cast_measures, clean, keep_operated, select_quarter
from contrail.operators.features import add_departure_hour, engineer_features, preview
from contrail.schemas import MEASURE_COLUMNS
from tests.trips import raw_trips


def column(df, name):
    return [r[name] for r in df.collect()]


def test_delay_flag_is_strict(spark):
    df = clean(raw_trips(spark, *[{"arrival_delay": d} for d in ("15", "15.5", "-3")]))
    assert column(df, "is_delayed") == [0, 1, 0]


@pytest.mark.parametrize("name", ["arrival_delay", "departure_delay"])
@pytest.mark.parametrize("bad", [None, "NaN", "", "abc"])
def test_trips_without_a_delay_are_dropped(spark, name, bad):
    assert clean(raw_trips(spark, {name: bad})).count() == 0


def test_only_plain_zero_is_operated(spark):
    df = raw_trips(spark, *[{"cancelled": c, "day": c} for c in ("0", "1", None, "0.0")])
    assert column(keep_operated(df), "cancelled") == ["0"]


def test_bad_numbers_become_null(spark):
    df = clean(raw_trips(spark, {"air_time": "abc", "taxi_in": "", "day": "x", "distance": "12.5"}))
    row = df.first()
    assert (row.air_time, row.taxi_in, row.day, row.distance) == (None, None, None, 12.5)


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("5", 5), ("5.0", 5), (" 7 ", 7), ("-3.9", -3), ("+4", 4), (".5", 0), ("0005", 5),
        ("abc", None), ("", None), ("5e1", None), ("2147483648", None), ("5.x", None),
        ("NaN", None), (None, None),
    ],
)
def test_text_to_int(spark, text, value):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(as_int("c").alias("v")).first().v == value


def test_missing_measure_is_left_out(spark):
    df = raw_trips(spark, {}).drop("taxi_in", "security_delay")
    out = cast_measures(df)
    assert out.columns == df.columns
    assert {t for c, t in out.dtypes if c in MEASURE_COLUMNS} == {"float"}


def test_types_after_cleaning(spark):
    types = dict(clean(raw_trips(spark, {})).dtypes)
    assert {types[c] for c in ("year", "month", "day", "day_of_week", "is_delayed")} == {"int"}
    assert types["scheduled_departure"] == types["cancelled"] == "string"


def test_upper_case_names(spark):
    df = raw_trips(spark, {})
    upper = df.toDF(*[c.upper() for c in df.columns])
    assert clean(upper).columns == clean(df).columns


MONTHS = [*range(0, 15), -1, None]


def test_quarter_label_and_predicate_agree(spark):
    df = spark.createDataFrame([(m,) for m in MONTHS], "month int").withColumn("q", quarter_label())
    labels = {r.month: r.q for r in df.collect()}
    assert labels[None] == labels[13] == labels[0] == "Q4"
    assert [labels[m] for m in (1, 3, 4, 6, 7, 9, 10, 12)] == [
        "Q1", "Q1", "Q2", "Q2", "Q3", "Q3", "Q4", "Q4",
    ]
    for quarter in ("Q1", "Q2", "Q3", "Q4"):
        by_month = df.filter(in_quarter(quarter))
        assert by_month.count() == df.filter(F.col("q") == quarter).count()
        assert set(column(by_month, "q")) == {quarter}


def test_no_quarter_selects_all(spark):
    df = spark.createDataFrame([(m,) for m in MONTHS], "month int")
    assert select_quarter(df, None).count() == len(MONTHS)


def test_route_of_unknown_origin_is_null(spark):
    df = clean(raw_trips(spark, {}, {"origin_airport": None}))
    assert column(df, "route") == ["SEA-CLT", None]


def test_departure_hour(spark):
    times = ("0005", "0959", "2400", None, "x")
    df = add_departure_hour(raw_trips(spark, *[{"scheduled_departure": t} for t in times]))
    assert column(df, "scheduled_departure_hour") == [0, 9, 24, None, None]


def test_cause_flags_and_total(spark):
    causes = ({}, {"weather_delay": "0"}, {"weather_delay": "-1"}, {"weather_delay": "2"},
              {"security_delay": "4", "late_aircraft_delay": "3", "airline_delay": "1.5"})
    df = engineer_features(clean(raw_trips(spark, *causes)))
    assert column(df, "has_weather_delay") == [0, 0, 0, 1, 0]
    assert column(df, "has_carrier_delay") == [0, 0, 0, 0, 1]
    assert column(df, "has_late_aircraft_delay") == [0, 0, 0, 0, 1]
    assert column(df, "total_delay_causes_min") == [0.0, 0.0, -1.0, 2.0, 8.5]
    assert dict(df.dtypes)["total_delay_causes_min"] == "float"


def test_preview_columns(spark):
    df = preview(engineer_features(clean(raw_trips(spark, {}))))
    assert tuple(df.first()) == ("AA", 6.0, 0, 9, 0, 0.0)


def test_missing_file_fails_before_any_task(spark, tmp_path):
    from contrail.sources.files import read_trips

    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_trips(spark, str(tmp_path / "none.csv"))
