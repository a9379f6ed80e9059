"""Settings, session, and the three jobs one after the other on folders."""

from __future__ import annotations

from unittest import mock

import pytest

from contrail import jobs
from contrail.plans.batch import RUN_LOG
from contrail.settings import Settings, create_spark_session
from contrail.sinks.store import FolderStore, JdbcStore
from tests.trips import airports, carriers, raw_trips

DATABASE = {"POSTGRES_HOST": "db", "POSTGRES_USER": "u", "POSTGRES_PASSWORD": "p"}


def test_defaults():
    settings = Settings.from_env({})
    assert settings.quarter is None
    assert settings.trips_path == "data/flights.csv"
    assert settings.processed_root == "lake/processed"


def test_unknown_quarter_is_refused():
    with pytest.raises(ValueError, match="QUARTER"):
        Settings.from_env({"QUARTER": "Q5"})


def test_store_needs_credentials():
    with pytest.raises(ValueError, match="POSTGRES_HOST"):
        Settings.from_env({}).feature_store({})
    with pytest.raises(KeyError, match="POSTGRES_PASSWORD"):
        Settings.from_env({"POSTGRES_HOST": "db"}).feature_store({"POSTGRES_USER": "u"})
    store = Settings.from_env(DATABASE).feature_store(DATABASE)
    assert isinstance(store, JdbcStore) and store.url == "jdbc:postgresql://db:5432/flight_features"


def test_topic_options():
    settings = Settings.from_env({"KAFKA_BROKER": "b:1", "KAFKA_TOPIC": "t"})
    assert settings.topic_sink()["topic"] == "t"
    source = settings.topic_source(rows_per_batch=10_000, min_tasks=64)
    assert source["maxOffsetsPerTrigger"] == "10000" and source["minPartitions"] == "64"
    assert "maxOffsetsPerTrigger" not in settings.topic_source()


def test_session_takes_the_object_store_from_the_environment(spark):
    session = create_spark_session(env={"S3_ENDPOINT": "http://s3:9000"})
    assert session.conf.get("spark.hadoop.fs.s3a.path.style.access") == "true"
    assert session.conf.get("spark.hadoop.fs.s3a.access.key", None) is None


def test_publish_land_process(spark, tmp_path, monkeypatch, capsys):
    data, topic = tmp_path / "data", str(tmp_path / "topic")
    months = [{"month": str(m)} for m in range(1, 13)]
    frames = {
        "flights": raw_trips(spark, *months, {"departure_time": None, "cancelled": "1"}),
        "airlines": carriers(spark),
        "airports": airports(spark),
    }
    for name, df in frames.items():
        upper = df.toDF(*[c.upper() for c in df.columns])
        upper.write.option("header", True).csv(str(data / f"{name}.csv"))
    for key, value in {
        "DATA_LOCAL_PATH": str(data),
        "LAKE_ROOT": str(tmp_path / "lake"),
        "FEATURE_STORE_ROOT": str(tmp_path / "store"),
    }.items():
        monkeypatch.setenv(key, value)
    monkeypatch.delenv("QUARTER", raising=False)
    store = FolderStore(str(tmp_path / "store"))

    def counts():
        rows = store.read(spark, "airline_features").collect()
        return {r.quarter: r.total_flights for r in rows}

    with (
        mock.patch.object(jobs, "create_spark_session", return_value=spark),
        mock.patch.object(type(spark), "stop"),
    ):
        jobs.main(["publish", "--format", "parquet", "--option", f"path={topic}"])
        printed = capsys.readouterr().out
        assert "'total_rows': 13, 'published': 12, 'skipped': 1" in printed
        jobs.main(["land", "--format", "parquet", "--option", f"path={topic}"])
        jobs.main(["process"])
        from_file = counts()
        jobs.main(["process", "--tables-only", "--names-from-header"])
        assert counts() == from_file
        jobs.main(["process", "--source", "lake", "--in-date-order"])
        assert counts() == from_file == {"Q1": 3, "Q2": 3, "Q3": 3, "Q4": 3}
        monkeypatch.setenv("QUARTER", "Q2")
        jobs.main(["process", "--source", "lake"])
        assert counts() == from_file
    log = store.read(spark, RUN_LOG).filter("stage = 'process' AND quarter = 'Q2'").first()
    assert (log.records_in, log.records_out) == (3, 3)
