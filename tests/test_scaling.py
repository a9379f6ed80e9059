"""What keeps the work of a query in proportion to its input."""

from __future__ import annotations

import datetime
import pathlib
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from contrail import fixture, registry, scratch
from contrail.operators.enrich import Lookups
from contrail.plans import batch
from contrail.scratch import in_pieces, staged
from contrail.sinks.store import FolderStore
from contrail.sinks.topic import publish
from contrail.sources.lake import read_processed
from contrail.streaming import landing

DAY = datetime.datetime(1996, 2, 3)


@pytest.fixture
def tables(spark, tmp_path):
    """A few rows of every table that the trips are made of."""
    rows = {
        "region": [(0, "R")],
        "nation": [(0, "N0", 0), (1, "N1", 0)],
        "customer": [(1, 0), (2, 1)],
        "supplier": [(1, "S1", 0, 10.0), (2, "S2", 1, 9000.0)],
        "orders": [(k, 1 + k % 2) for k in range(1, 9)],
        "lineitem": [(1 + k % 8, k, 1 + k % 2, 1 + k % 4, 30.0 + k, 100.0, "A", DAY) for k in range(40)],
    }
    for name, found in rows.items():
        df = spark.createDataFrame(found, fixture._TABLES[name])
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def _plan(df, kind="executedPlan") -> list[str]:
    return getattr(df._jdf.queryExecution(), kind)().toString().splitlines()


def _below(lines: list[str], words: str) -> str:
    """The part of a plan under the first line with ``words``, and that line."""
    def depth(line):
        return next((i for i, c in enumerate(line) if c.isalnum()), 0)

    at = next(i for i, line in enumerate(lines) if words in line)
    end = next((i for i in range(at + 1, len(lines)) if depth(lines[i]) <= depth(lines[at])), len(lines))
    return "\n".join(lines[at:end])


def test_narrow_tables_are_joined_before_lineitem(spark, tables, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    plan = _plan(fixture.raw_trips(spark, tables))
    shuffled = _below(plan, "hashpartitioning(o_custkey")
    assert "o_orderkey" in shuffled and "l_orderkey" not in shuffled
    assert fixture.raw_trips(spark, tables).count() == 40


def test_copies_are_sent_by_many_tasks_and_equal_keys_by_one(spark, conf):
    conf(spark__sql__adaptive__enabled="false")
    sent = spark.range(0, 200, 1, 4).select(F.concat(F.lit("k"), F.col("id") % 50).alias("key"), F.col("id").cast("string").alias("value"))
    dealt = registry._twice_together(sent).select("key", "value", F.spark_partition_id().alias("task"))
    assert dealt.select("task").distinct().count() > 1
    assert dealt.groupBy("key").agg(F.countDistinct("task").alias("n")).filter("n > 1").count() == 0
    assert sorted(dealt.select("value").toPandas()["value"]) == sorted([str(i) for i in range(200)] * 2)


def test_halves_of_the_trips_are_told_before_the_joins(spark, tables):
    trips = fixture.raw_trips(spark, tables)
    second = registry._second_half()
    plan = _plan(trips.filter(second), "optimizedPlan")
    at = [i for i, line in enumerate(plan) if "xxhash64" in line]
    assert len(at) == 1 and "Filter" in plan[at[0]] and "Relation" in plan[at[0] + 1]
    assert 0 < trips.filter(second).count() < 40
    assert trips.filter(second).count() + trips.filter(~second).count() == 40


def test_broken_messages_are_made_from_the_topic(spark, tables, monkeypatch):
    frames = []

    def spied(messages, *args):
        frames.append(messages)
        publish(messages, *args)

    publish = registry.publish
    monkeypatch.setattr(registry, "publish", spied)
    assert registry.stream_land_broken(spark, tables).count() == 80
    assert [any("Join" in line for line in _plan(f, "optimizedPlan")) for f in frames] == [True, False]


def test_trips_are_dealt_without_the_names_they_get(spark, tables, tmp_path, monkeypatch):
    seen = []

    def spied(trips, root, compact=True):
        seen.append((trips, compact))
        return write(trips, root, compact)

    write = batch.write_version
    monkeypatch.setattr(batch, "write_version", spied)
    raw, carriers, airports = fixture.raw_trips(spark, tables), fixture.carriers(spark, tables), fixture.airports(spark, tables)
    batch.run(spark, raw, carriers, airports, FolderStore(f"{tmp_path}/store"), f"{tmp_path}/lake")
    (trips, compact), = seen
    dealt = _below(_plan(trips, "optimizedPlan"), "RebalancePartitions")
    assert "airline_name" not in dealt and not compact


def test_trips_are_dealt_last_if_names_need_a_shuffle(spark, tables, tmp_path, monkeypatch, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    seen = []
    write = batch.write_version
    monkeypatch.setattr(batch, "write_version", lambda trips, root, compact: (seen.append(compact), write(trips, root, compact))[1])
    raw, carriers, airports = fixture.raw_trips(spark, tables), fixture.carriers(spark, tables), fixture.airports(spark, tables)
    assert not Lookups.measure(carriers, airports).broadcast(spark)
    batch.run(spark, raw, carriers, airports, FolderStore(f"{tmp_path}/store"), f"{tmp_path}/lake")
    assert seen == [True]


def test_a_table_is_read_in_pieces(spark, tmp_path, conf):
    conf(spark__sql__session__timeZone="Asia/Tokyo")
    spark.range(0, 400_000, 1, 1).write.option("parquet.block.size", 1 << 18).parquet(f"{tmp_path}/t")
    own = in_pieces(spark, 1 << 18)
    pieces = own.read.parquet(f"{tmp_path}/t")
    assert pieces.rdd.getNumPartitions() >= 5 and pieces.count() == 400_000
    assert own.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != own.conf.get("spark.sql.files.maxPartitionBytes")


def _shuffle_files(spark) -> int:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(found.apply(i).getName().startswith("shuffle_") for i in range(found.size()))


def _codecs(folder) -> set[str]:
    files = list(pathlib.Path(folder).rglob("part-*.parquet"))
    groups = [m.row_group(i) for m in (pq.ParquetFile(f).metadata for f in files) for i in range(m.num_row_groups)]
    return {group.column(0).compression for group in groups}


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    before = _shuffle_files(spark)
    sent = spark.range(0, 1000, 1, 4).select(F.col("id").cast("string").alias("key"), F.lit("v").alias("value"))
    publish(sent.repartition(5, "key"), "parquet", {"path": f"{tmp_path}/topic"})
    staged(sent.repartition(5, "key"), "t", path=f"{tmp_path}/t")
    until = time.time() + 20
    while _shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert _shuffle_files(spark) <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert _codecs(f"{tmp_path}/t") == {"ZSTD"}


def test_the_lake_of_broken_messages_and_their_topic_are_lean(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "shared_folder", lambda spark: f"{tmp_path}/shared")
    assert registry.stream_land_broken(spark, tables).count() == 80
    for label in ("topic", "raw"):
        (folder,) = (tmp_path / "shared").glob(f"{label}-*")
        assert _codecs(folder) == {"ZSTD"}, label


def test_slices_hold_a_table_once(spark, tmp_path, monkeypatch):
    """Folders stay together up to the size of a slice; what is read is removed."""
    monkeypatch.setattr(scratch, "shared_folder", lambda spark: f"{tmp_path}/shared")
    number = F.when(F.col("id") % 5 > 0, F.col("id") % 5).cast("int")
    df = spark.range(0, 1000, 1, 4).select("id", number.alias("year"), F.lit("Q1").alias("quarter"))
    by = ("year", "quarter")
    assert [t.count() for t in scratch.in_slices(df, "t", by, spark)] == [1000]
    monkeypatch.setattr(scratch, "SLICE_BYTES", 1)
    monkeypatch.setattr(scratch, "MOST_SLICES", 5)
    found = []
    for part in scratch.in_slices(df, "t", by, spark):
        assert part.columns == df.columns
        found.append([tuple(r) for r in part.collect()])
    assert len(found) >= 5 and sorted(r for rows in found for r in rows if r[1]) == sorted(tuple(r) for r in df.filter("year > 0").collect())
    assert sum(map(len, found)) == 1000
    whole = [{r[1] for r in rows} for rows in found]
    assert all(not a & b for i, a in enumerate(whole) for b in whole[:i])
    monkeypatch.setattr(scratch, "MOST_SLICES", 100)
    files = [t.count() for t in scratch.in_slices(df, "t", by, spark, split=True)]
    assert len(files) == 20 and sum(files) == 1000
    assert [t.count() for t in scratch.in_slices(df.limit(0), "t", by, spark)] == [0]
    assert not [f for f in (tmp_path / "shared").rglob("part-*")]


def test_months_are_dealt_some_at_a_time(spark, tables, monkeypatch):
    """The rows that are dealt lie in shuffle files, of one slice only."""
    expected = sorted(map(repr, registry.stream_land_raw(spark, tables).collect()))
    sizes, sized = [], landing.sized_by_month
    monkeypatch.setattr(scratch, "SLICE_BYTES", 1)
    monkeypatch.setattr(landing, "sized_by_month", lambda rows, n: (sizes.append(rows.count()), sized(rows, n))[1])
    assert sorted(map(repr, registry.stream_land_sized(spark, tables).collect())) == expected
    assert len(sizes) > 1 and sum(sizes) == len(expected)


def test_a_run_deals_some_partitions_at_a_time(spark, tables, tmp_path, monkeypatch):
    """The lake, tables and counts are those of a run in one piece."""
    trips = fixture.raw_trips(spark, tables).withColumn("MONTH", F.col("FLIGHT_NUMBER").cast("int") % 12 + 1)
    trips = trips.withColumn("YEAR", F.when(F.col("FLIGHT_NUMBER").cast("int") % 5 > 0, F.lit("1996")))
    names = fixture.carriers(spark, tables), fixture.airports(spark, tables)
    written, write = [], batch.write_version
    monkeypatch.setattr(batch, "write_version", lambda *given: (written.append(write(*given)), written[-1])[1])

    def made(label):
        written.clear()
        store, root = FolderStore(f"{tmp_path}/{label}-store"), f"{tmp_path}/{label}"
        for given in ((trips,), (trips.withColumn("CANCELLED", F.lit("1")), "Q1")):
            batch.run(spark, given[0], *names, store, root, *given[1:])
        log = store.read(spark, batch.RUN_LOG).select("quarter", "stage", "status", "records_in", "records_out")
        tables_of = [store.read(spark, n).drop("processed_at") for n in ("airline_features", "route_features")]
        return [sorted(map(repr, df.collect())) for df in (read_processed(spark, root), log, *tables_of)]

    expected = made("whole")
    assert len(written) == 2 and len(expected[0]) > 10
    monkeypatch.setattr(scratch, "SLICE_BYTES", 1)
    assert made("slices") == expected
    first = written[:-1]
    assert len(first) > 3 and len({w.version for w in first}) == len(first)
    assert len({p for w in first for p in w.partitions}) == sum(len(w.partitions) for w in first)


def test_trip_files_are_compressed(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "shared_folder", lambda spark: f"{tmp_path}/shared")
    assert registry.csv_scan_all_string(spark, tables).count() == 40
    assert list((tmp_path / "shared").glob("trips_csv-*/*.csv.gz"))
    assert not list((tmp_path / "shared").glob("trips_csv-*/*.csv"))


def test_resumed_files_can_be_split_and_their_topic_is_lean(spark, tables, tmp_path, monkeypatch):
    """A batch is two files: all tasks share them only if they are not compressed."""
    monkeypatch.setattr(scratch, "shared_folder", lambda spark: f"{tmp_path}/shared")
    assert registry.publish_resumed(spark, tables).count() == 40
    (topic,) = (tmp_path / "shared").glob("topic-*")
    assert _codecs(topic) == {"ZSTD"} and list((tmp_path / "shared").glob("trips-*/*.csv"))
