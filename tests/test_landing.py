"""Streaming landing from a folder that stands for the topic."""

from __future__ import annotations

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from contrail.operators.messages import from_messages, to_messages
from contrail.scratch import shared_folder
from contrail.sinks.topic import publish
from contrail.sources.lake import read_raw
from contrail.streaming import landing as landing_module
from contrail.streaming import seen as seen_module
from contrail.streaming.landing import Landing, first_of_each, land, read_topic
from contrail.streaming.seen import SeenIndex, bloom, may_hold
from tests.trips import raw_trips, rows_of

AT = "2015-02-01T00:00:00"


@pytest.fixture
def folders(tmp_path):
    return str(tmp_path / "topic"), str(tmp_path / "raw"), str(tmp_path / "checkpoint")


def send(spark, topic, *changes):
    publish(to_messages(raw_trips(spark, *changes), AT), "parquet", {"path": topic})


def land_all(spark, folders, index=None, file_bytes=None, report=None, **options):
    topic, root, checkpoint = folders
    stream = read_topic(spark, "parquet", {"path": topic, **options})
    report = report if report is not None else []
    land(stream, root, checkpoint, index, file_bytes, report.append).awaitTermination()
    return read_raw(spark, root)


def test_second_run_adds_nothing_and_new_messages_are_added(spark, folders):
    send(spark, folders[0], {"day": "1"}, {"day": "2", "month": "2"})
    first = rows_of(land_all(spark, folders))
    assert rows_of(land_all(spark, folders)) == first and len(first) == 2
    send(spark, folders[0], {"day": "3"})
    assert land_all(spark, folders).count() == 3
    assert os.path.isdir(f"{folders[1]}/year=2015/month=2")


def test_unreadable_date_is_landed_too(spark, folders):
    send(spark, folders[0], {"year": "x"}, {"month": ""}, {})
    assert land_all(spark, folders).count() == 3


def test_without_dedupe_repeats_are_kept(spark, folders):
    send(spark, folders[0], {}, {})
    assert land_all(spark, folders).count() == 2


OTHERS = [{"destination_airport": f"D{i}"} for i in range(10)] + [{"scheduled_departure": "1"}]
# What is sent, file by file: one trip makes up half of all messages, the others differ in route or time
# only. Repeats of a trip differ in what does not identify it, so it matters which one is landed.
SENT = [
    [{"arrival_delay": str(k)} for k in range(11)] + OTHERS,
    [*OTHERS, {"arrival_delay": "-1"}, {"year": "x"}, {"year": "x", "taxi_in": "9"}, {"month": ""}],
    [{"arrival_delay": "99"}, {"origin_airport": "new"}, {"month": "2"}, {"month": "2", "taxi_in": "5"}],
    [{"month": "2", "taxi_in": "6"}, {"year": "x"}],
]


def send_file(spark, topic, k):
    messages = to_messages(raw_trips(spark, *SENT[k]), AT)
    broken = spark.createDataFrame([("k", "{no"), ("k", f"{{no {k}")], "key string, value string")
    publish(messages.union(broken).coalesce(1), "parquet", {"path": topic})


def whole(df):
    return sorted(repr(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("way", ["batches", "runs", "fresh checkpoint", "one file a run and all again"])
def test_repeats_do_not_depend_on_batches(spark, folders, tmp_path, way):
    """The same rows, all columns, whether the files come as one batch, as many, in several runs, or once
    more after the checkpoint is lost."""
    topic, root, checkpoint = folders
    for k in range(len(SENT)):
        send_file(spark, topic, k)
    expected = whole(land_all(spark, (topic, str(tmp_path / "one"), str(tmp_path / "c")), str(tmp_path / "i")))
    assert len(expected) == 21
    index, report = str(tmp_path / "seen"), []
    if way == "batches":
        land_all(spark, folders, index, report=report, maxFilesPerTrigger="1")
    elif way == "runs":
        folders = (str(tmp_path / "later"), root, checkpoint)
        for k in range(len(SENT)):
            send_file(spark, folders[0], k)
            land_all(spark, folders, index, report=report)
    else:
        files = "1" if way.startswith("one") else "1000"
        for run in range(2):
            folders = (topic, root, f"{checkpoint}-{run}")
            land_all(spark, folders, index, report=report, maxFilesPerTrigger=files)
        assert sum(c.landed for c in report) == 21
    assert whole(read_raw(spark, root)) == expected
    assert all(c.messages == c.landed + c.repeats for c in report)
    assert sum(c.unreadable for c in report) == 8 * (2 if "fresh" in way or "again" in way else 1)


def test_a_batch_that_is_run_again_takes_no_row_for_a_repeat(spark, folders, tmp_path):
    """Fails after the rows are written, and once more after the index is extended."""
    topic, root, _ = folders
    send_file(spark, topic, 0)
    messages = spark.read.parquet(topic).withColumn("arrival", F.lit("a"))
    report = []
    landing = Landing(spark, root, str(tmp_path / "seen"), 100, report.append)
    before = shared_folder(spark)
    extend, counts = SeenIndex.extend, []

    def broken(self, keys, rows, label):
        if len(counts) == 1:
            extend(self, keys, rows, label)
        counts.append(rows)
        raise OSError("lost")

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(SeenIndex, "extend", broken)
        for _ in range(2):
            with pytest.raises(OSError):
                landing(messages, 0)
    assert counts == [14, 14] and not report
    landing(messages, 0)
    assert read_raw(spark, root).count() == 14
    landing(messages, 1)
    assert read_raw(spark, root).count() == 14
    assert [(c.landed, c.repeats) for c in report] == [(14, 10), (0, 24)]
    left = [f for f in os.listdir(before) if f.split("-")[0] in ("landing", "fresh", "maybe", "seen", "months")]
    assert not left


def test_known_trips_are_told_by_their_identities(spark, folders, tmp_path, monkeypatch):
    """What a batch has of known trips is neither shuffled nor written as whole rows."""
    send_file(spark, folders[0], 0)
    index, report, made = str(tmp_path / "seen"), [], {}
    before = whole(land_all(spark, folders, index))
    staged = landing_module.staged

    def spied(df, label, *given, **named):
        made[label] = df
        return staged(df, label, *given, **named)

    monkeypatch.setattr(landing_module, "staged", spied)
    again = land_all(spark, (*folders[:2], f"{folders[2]}-2"), index, report=report)
    assert whole(again) == before and [(c.landed, c.repeats) for c in report] == [(0, 24)]
    assert set(made["keys"].columns) == {"year", "month", "digest"} and made["fresh"].columns == ["digest"]
    assert made["landing"].count() == 0
    assert "Exchange" not in made["landing"]._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_some_known_trips_among_new_ones(spark, folders, tmp_path, conf, threshold):
    conf(spark__sql__autoBroadcastJoinThreshold=threshold)
    index, report = str(tmp_path / "seen"), []
    send_file(spark, folders[0], 0)
    land_all(spark, folders, index, report=report)
    for k in range(1, len(SENT)):
        send_file(spark, folders[0], k)
    found = land_all(spark, (*folders[:2], f"{folders[2]}-2"), index, report=report)
    expected = land_all(spark, (folders[0], str(tmp_path / "one"), str(tmp_path / "c")), str(tmp_path / "i"))
    assert whole(found) == whole(expected) and [c.landed for c in report] == [14, 7]


def test_one_trip_with_very_many_copies(spark, tmp_path):
    """Copies are reduced before the shuffle: a task per file sends one row of the trip."""
    trip = to_messages(raw_trips(spark, {}), AT)
    many = trip.crossJoin(spark.range(0, 20_000, numPartitions=4)).withColumn("arrival", F.lit("a")).drop("id")
    rows = first_of_each(from_messages(many, [F.col("arrival")]))
    assert rows.count() == 1
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange")


def test_filters_find_all_and_pieces_nest(spark, tmp_path, monkeypatch):
    """Pieces of any size meet: a few identities asked of a large batch's filters, and many of a small's."""
    monkeypatch.setattr(seen_module, "PIECE_ROWS", 50)
    keys = spark.range(2000).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 3).cast("int").alias("year"), F.lit(1).alias("month"),
        F.unhex(F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 32)).alias("digest"), "id",
    )
    index = SeenIndex(spark, str(tmp_path / "seen"))
    assert index.seen(keys, 2000, "z") is None
    index.extend(keys.filter("id < 1000"), 1000, "a")
    index.extend(keys.filter("id >= 1000 AND id < 1010"), 10, "b")

    def found(asked, label):
        own = keys.filter(asked)
        return sorted(r["id"] for r in own.join(index.seen(own, own.count(), label), "digest").collect())

    assert found("id >= 0", "c") == list(range(1010))
    assert found("id >= 990 AND id < 1020", "c") == list(range(990, 1010))
    assert found("id >= 990 AND id < 1020", "b") == list(range(990, 1000))
    assert found("id >= 1500", "c") == []
    others = [hashlib.sha256(str(k).encode()).digest()[:16] for k in range(20_000)]
    assert may_hold(bloom(others[:2000]), others[:2000]).all()
    assert may_hold(bloom(others[:2000]), others[2000:]).mean() < 0.02
    assert not may_hold(bloom([]), others).any()


def test_a_compacted_index_knows_the_same_trips(spark, folders, tmp_path, monkeypatch):
    """Also when a rewrite fails on its way, and when another follows."""
    topic, root, checkpoint = folders
    index = SeenIndex(spark, str(tmp_path / "seen"))
    assert index.compact() == 0
    for k in range(len(SENT)):
        send_file(spark, topic, k)
    land_all(spark, folders, index.root, maxFilesPerTrigger="1")
    with monkeypatch.context() as patch:
        patch.setattr(seen_module, "write_new", lambda *given: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            index.compact()
    files = list((tmp_path / "seen" / "first" / "keys").rglob("*.parquet"))
    for run in range(2):
        assert index.compact() == 21
        report = []
        land_all(spark, (topic, root, f"{checkpoint}-{run}"), index.root, report=report)
        assert [(c.landed, c.repeats) for c in report] == [(0, sum(map(len, SENT)) + 8)]
    left = list((tmp_path / "seen").rglob("keys/**/*.parquet"))
    assert not (tmp_path / "seen" / "first").exists() and len(files) > 3
    assert len([f for f in left if f.is_file()]) <= 2 * len(files)
    assert read_raw(spark, root).count() == 21


def test_months_get_files_by_their_size(spark, folders):
    """Nine tenths of the rows are of one month, and messages come shuffled. Its files are bounded by
    size; the other months, null ones too, have one or two each."""
    big = [{"month": "1", "day": str(d % 28), "flight_number": str(d)} for d in range(1800)]
    small = [{"month": str(m), "flight_number": str(d)} for m in (2, 3, "x") for d in range(66)]
    mixed = to_messages(raw_trips(spark, *big, *small), AT).orderBy(F.xxhash64("key")).repartition(6)
    publish(mixed, "parquet", {"path": folders[0]})
    landed = land_all(spark, folders, None, 20_000)
    assert landed.count() == 1998
    size = sum(F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) for c in landed.columns) + 1
    files = landed.groupBy("month", F.input_file_name().alias("file")).agg(F.sum(size).alias("bytes"))
    found = {r["month"]: r for r in files.groupBy("month").agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.max("bytes").alias("most")
    ).collect()}
    for month, r in found.items():
        assert r["files"] <= r["bytes"] / 20_000 + 2, month
        assert r["most"] <= 20_000 * 1.3
    assert found[1]["files"] >= 8 and found.keys() == {1, 2, 3, None}
    assert files.select("file").distinct().count() <= sum(r["files"] for r in found.values())


def test_a_lake_of_a_file_sink_is_refused(spark, folders):
    os.makedirs(f"{folders[1]}/_spark_metadata")
    send(spark, folders[0], {})
    with pytest.raises(ValueError, match="file sink"):
        land_all(spark, folders)
