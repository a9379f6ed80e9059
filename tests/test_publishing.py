"""Publishing file by file, resumed after a failure; input without a needed column; committers."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql.utils import StreamingQueryException

from contrail.operators.messages import publish_stats, to_messages
from contrail.settings import committer_settings, session_settings
from contrail.streaming import publishing
from contrail.streaming.publishing import publish_files, read_trip_files
from tests.trips import raw_trips

AT = "2015-02-01T00:00:00"


def trip_files(spark, folder, *days):
    for day in days:
        rows = raw_trips(spark, *[{"day": str(day), "flight_number": str(n)} for n in range(5)], {"departure_time": ""})
        named = rows.toDF(*[c.upper() for c in rows.columns])
        named.coalesce(1).write.mode("append").option("header", True).csv(folder)


@pytest.fixture
def send(spark, tmp_path):
    def run():
        found = []
        trips = read_trip_files(spark, str(tmp_path / "trips"), 1)
        topic = {"path": str(tmp_path / "topic")}
        try:
            publish_files(trips, "parquet", topic, str(tmp_path / "ledger"), found.append, AT).awaitTermination()
        finally:
            run.sent += found
        return found

    run.sent = []
    return run


def in_topic(spark, tmp_path):
    return Counter(r["key"] for r in spark.read.parquet(str(tmp_path / "topic")).collect())


def test_only_new_files_are_sent(spark, tmp_path, send):
    trip_files(spark, str(tmp_path / "trips"), 1, 2, 3)
    assert [(s.total_rows, s.published) for s in send()] == [(6, 5)] * 3
    assert send() == []
    trip_files(spark, str(tmp_path / "trips"), 4)
    assert [(s.total_rows, s.published) for s in send()] == [(6, 5)]
    found = in_topic(spark, tmp_path)
    assert len(found) == 20 and set(found.values()) == {1}


@pytest.mark.parametrize("broken", ["before", "after"])
def test_a_run_that_fails_is_resumed(spark, tmp_path, send, monkeypatch, broken):
    """The third of four files fails before its messages are out, or after, when only they go again."""
    trip_files(spark, str(tmp_path / "trips"), 1, 2, 3, 4)
    publish, calls = publishing.publish, []

    def failing(messages, fmt, options):
        calls.append(fmt)
        if len(calls) != 3 or broken == "after":
            publish(messages, fmt, options)
        if len(calls) == 3:
            raise OSError("broker is down")

    monkeypatch.setattr(publishing, "publish", failing)
    with pytest.raises(StreamingQueryException, match="broker is down"):
        send()
    assert len(send.sent) == 2
    send()
    assert len(send.sent) == 4 and len(calls) == 5
    found = in_topic(spark, tmp_path)
    assert len(found) == 20
    assert Counter(found.values()) == ({1: 20} if broken == "before" else {1: 15, 2: 5})


def test_a_single_file_is_an_input_too(spark, tmp_path):
    trip_files(spark, str(tmp_path / "trips"), 1)
    path = next((tmp_path / "trips").glob("*.csv"))
    found, topic = [], {"path": str(tmp_path / "topic")}
    trips = read_trip_files(spark, str(path), 10)
    publish_files(trips, "parquet", topic, str(tmp_path / "ledger"), found.append).awaitTermination()
    assert [(s.total_rows, s.published) for s in found] == [(6, 5)]


@pytest.mark.parametrize("column", ["flight_number", "departure_time"])
def test_input_without_a_needed_column_has_nothing_to_publish(spark, column):
    trips = raw_trips(spark, {}, {"day": "9"}).drop(column)
    assert to_messages(trips, AT).count() == 0
    assert tuple(publish_stats(trips).first()) == (2, 0, 2)


def test_the_committer_is_chosen_by_the_scheme():
    assert committer_settings("/data/lake", "hdfs://name/lake", None) == {}
    found = committer_settings("s3a://bucket/lake", "/store")
    assert found["spark.hadoop.fs.s3a.committer.name"] == "magic"
    assert found["spark.sql.sources.commitProtocolClass"].endswith("PathOutputCommitProtocol")
    both = committer_settings("gs://bucket/lake", "abfss://c@a.net/store")
    factories = {k.rsplit(".", 1)[1]: v for k, v in both.items() if "factory.scheme" in k}
    assert factories.keys() == {"gs", "abfss"} and all("Manifest" in v for v in factories.values())
    env = {"LAKE_ROOT": "s3a://bucket/lake", "S3_ENDPOINT": "http://s3:9000"}
    settings = session_settings(env)
    assert settings.items() >= found.items() and settings["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert "spark.hadoop.fs.s3a.access.key" not in settings
    assert not any("committer" in k for k in session_settings({"LAKE_ROOT": "lake"}))
