"""CSV headers, and where intermediate tables go."""

from __future__ import annotations

from unittest import mock

import pytest

from contrail.operators.clean import clean
from contrail.schemas import RAW_TRIPS
from contrail.scratch import materialise, new_path, shared_folder
from contrail.sources.files import read_lookup, read_trips
from tests.trips import airports, raw_trips, rows_of


def write(df, path) -> str:
    df.toDF(*[c.upper() for c in df.columns]).write.option("header", True).csv(str(path))
    return str(path)


def test_all_columns_are_text_and_blanks_are_null(spark, tmp_path):
    trips = raw_trips(spark, {}, {"tail_number": "", "day": "5.0"})
    df = read_trips(spark, write(trips, tmp_path / "t"))
    assert df.schema == RAW_TRIPS
    assert {r.TAIL_NUMBER for r in df.collect()} == {"N1", None}


def test_other_header_is_an_error(spark, tmp_path):
    path = write(raw_trips(spark, {}).drop("taxi_in"), tmp_path / "t")
    with pytest.raises(Exception, match="header"):
        read_trips(spark, path).collect()


def test_names_from_header(spark, tmp_path):
    trips = raw_trips(spark, {}, {"arrival_delay": "40"})
    other = trips.select("weather_delay", *[c for c in trips.columns if c != "weather_delay"])
    path = write(other.drop("taxi_in"), tmp_path / "t")
    df = clean(read_trips(spark, path, schema=None))
    assert "taxi_in" not in df.columns
    assert rows_of(df.select("arrival_delay", "is_delayed")) == ["(-3.0, 0)", "(40.0, 1)"]


def test_lookup_names_are_lower_case_text(spark, tmp_path):
    df = read_lookup(spark, write(airports(spark), tmp_path / "a"))
    assert df.columns == airports(spark).columns
    assert {t for _, t in df.dtypes} == {"string"}


def session_with(**settings):
    session = mock.Mock()
    session.conf.get = lambda key, default=None: settings.get(key.replace(".", "_"), default)
    return session


def test_shared_folder_is_the_configured_one():
    session = session_with(spark_checkpoint_dir="hdfs://cluster/shared/", spark_master="yarn")
    assert shared_folder(session) == "hdfs://cluster/shared"
    assert new_path(session, "x").startswith("hdfs://cluster/shared/x-")


def test_only_a_local_session_may_go_without():
    local = session_with(spark_master="local[8]")
    assert shared_folder(local) == shared_folder(local)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session_with(spark_master="yarn"))


def test_materialised_table_has_the_same_rows(spark):
    df = spark.range(10).selectExpr("id", "CAST(id % 3 AS STRING) AS part")
    kept = materialise(df, "test", partition_by="part")
    assert rows_of(kept.select("id", "part")) == rows_of(df)
