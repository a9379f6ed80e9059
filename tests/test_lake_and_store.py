"""Partitioned lake, feature store and run log."""

from __future__ import annotations

import io
from contextlib import redirect_stdout
from unittest import mock

import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from contrail.files import write_new
from contrail.operators.aggregates import FEATURE_TABLES
from contrail.operators.clean import clean
from contrail.operators.enrich import Lookups, enrich
from contrail.operators.features import engineer_features
from contrail.operators.messages import from_messages, to_messages
from contrail.plans.batch import RUN_LOG, run
from contrail.sinks import lake
from contrail.sinks.lake import read_version, remove_old_versions, write_processed, write_version
from contrail.sinks.store import (
    REQUIRED, TEXT_LENGTHS, FolderStore, JdbcStore, check_declared, load_features, lookup_features,
)
from contrail.sources.files import read_trips
from contrail.sources.lake import read_processed, read_raw
from tests.trips import airports, carriers, raw_trips, rows_of


def plan_of(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def featured(spark, *changes):
    lookups = Lookups.measure(carriers(spark), airports(spark))
    return engineer_features(enrich(clean(raw_trips(spark, *changes)), lookups))


MONTHS = [{"month": str(m)} for m in (1, 2, 5, 8, 12)] + [{"month": "x"}, {"year": "x"}]


@pytest.mark.parametrize("compact", [False, True])
def test_overwrite_replaces_only_touched_partitions(spark, tmp_path, compact):
    root = str(tmp_path / "processed")
    first = write_processed(featured(spark, *MONTHS), root, compact)
    assert first.rows == 7
    assert first.partitions == [
        (2015, "Q1"), (2015, "Q2"), (2015, "Q3"), (2015, "Q4"), (None, "Q1"),
    ]
    again = write_processed(featured(spark, {"month": "3"}), root, compact)
    assert again.partitions == [(2015, "Q1")]
    by_quarter = {r.quarter: r["count"] for r in
                  read_processed(spark, root, 2015).groupBy("quarter").count().collect()}
    assert by_quarter == {"Q1": 1, "Q2": 1, "Q3": 1, "Q4": 2}
    schema = read_processed(spark, root).schema
    assert read_version(spark, root, first, schema).count() == 7
    assert read_version(spark, root, again, schema).count() == 1
    assert read_processed(spark, root, quarter="Q3").count() == 1
    assert read_processed(spark, root).count() == 6


def test_nothing_written_reads_nothing(spark, tmp_path):
    root = str(tmp_path / "processed")
    write_processed(featured(spark, {}), root)
    empty = write_processed(featured(spark, {"cancelled": "1"}), root)
    assert empty.rows == 0
    whole = read_processed(spark, root)
    assert read_version(spark, root, empty, whole.schema).count() == 0
    assert whole.count() == 1


def test_a_run_that_fails_between_partitions_changes_nothing(spark, tmp_path):
    """The write stops in its second quarter, or before the manifest; then a run empties a quarter and
    replaces another at once."""
    root = str(tmp_path / "processed")
    write_processed(featured(spark, *MONTHS), root)
    before = rows_of(read_processed(spark, root))
    half = featured(spark, {"month": "1"}, {"month": "5", "day": "9"})
    failing = F.when(F.col("day") == 9, F.raise_error(F.lit("lost"))).otherwise(F.col("route"))
    with pytest.raises(Exception, match="lost"):
        write_processed(half.withColumn("route", failing), root, compact=False)
    assert rows_of(read_processed(spark, root)) == before
    write_version(half, root)
    assert rows_of(read_processed(spark, root)) == before
    write_processed(featured(spark, {"month": "2"}), root, touched=[(2015, "Q2"), (2015, "Q1")])
    found = read_processed(spark, root).groupBy("year", "quarter").count().collect()
    assert sorted(map(tuple, found), key=str) == [(2015, "Q1", 1), (2015, "Q3", 1), (2015, "Q4", 2), (None, "Q1", 1)]


def test_readers_keep_what_they_started_with(spark, tmp_path):
    """Versions of the last two manifests stay; a half-done write is not taken for an old version."""
    root = str(tmp_path / "processed")
    write_processed(featured(spark, {"month": "1"}, {"month": "5"}), root)
    reader = read_processed(spark, root)
    write_processed(featured(spark, {"month": "2"}), root)
    assert remove_old_versions(spark, root) == 0
    assert sorted(r.month for r in reader.collect()) == [1, 5]
    under_way = write_version(featured(spark, {"month": "3"}), root)
    write_processed(featured(spark, {"month": "2", "day": "7"}), root)
    assert remove_old_versions(spark, root) == 1
    assert sorted(r.month for r in read_processed(spark, root).collect()) == [2, 5]
    assert read_version(spark, root, under_way, reader.schema).count() == 1
    assert len(list((tmp_path / "processed" / "_manifests").glob("*.json"))) == 2


def test_two_runs_that_publish_at_once(spark, tmp_path, monkeypatch):
    """The slower one finds its number taken and goes on from the other's manifest."""
    root = str(tmp_path / "processed")
    write_processed(featured(spark, {"month": "1"}), root)
    slow, fast = (featured(spark, {"month": m}) for m in ("5", "8"))
    written, taken = write_version(slow, root), []

    def late(spark, path, text):
        if not taken:
            taken.append(path)
            write_processed(fast, root)
        return write_new(spark, path, text)

    monkeypatch.setattr(lake, "write_new", late)
    lake.publish(spark, root, written, slow.schema, ())
    assert lake.current(spark, root).number == 3
    assert sorted(r.month for r in read_processed(spark, root).collect()) == [1, 5, 8]


def test_nothing_published_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="published"):
        read_processed(spark, str(tmp_path))


def test_coverage_is_observed_or_asked(spark, tmp_path):
    """Years far off are too many to observe; both ways give the same."""
    for changes in (MONTHS, [*MONTHS, {"year": "99999"}, {"year": "-5"}], []):
        raw = raw_trips(spark, *changes)
        for quarter in (None, "Q4"):
            coverage = lake.Coverage()
            coverage.watch(raw).write.format("noop").mode("overwrite").save()
            assert coverage.found(raw, quarter) == lake.covered(raw, quarter)


def test_raw_lake_reads_only_the_asked_months(spark, tmp_path):
    root = str(tmp_path / "raw")
    landed = from_messages(to_messages(raw_trips(spark, *MONTHS)))
    landed.write.partitionBy("year", "month").parquet(root)
    (tmp_path / "raw" / "year=2015" / "month=3").mkdir()
    (tmp_path / "raw" / "year=2015" / "month=3" / ".keep").touch()
    assert read_raw(spark, root, 2015, (1, 2)).count() == 2
    assert read_raw(spark, root, quarter="Q4").count() == 2
    plan = plan_of(read_raw(spark, root, 2015, quarter="Q1"))
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "year" in filters and "month" in filters


def test_raw_lake_without_files_is_empty(spark, tmp_path):
    (tmp_path / "year=2015").mkdir()
    (tmp_path / "year=2015" / ".keep").touch()
    assert read_raw(spark, str(tmp_path)).count() == 0


LOADS = [f"load_{name}" for name in FEATURE_TABLES]


def rerun(spark, tmp_path, changes, quarter=None, store=None, **options):
    store = store or FolderStore(str(tmp_path / "store"))
    lookups = carriers(spark), airports(spark)
    options.setdefault("processed_root", str(tmp_path / "processed"))
    result = run(
        spark, raw_trips(spark, *changes), *lookups, store, quarter=quarter, **options
    )
    return store, result


def stage_rows(spark, store):
    columns = ("run_id", "quarter", "stage", "status", "records_in", "records_out")
    return {r.stage: r for r in store.read(spark, RUN_LOG).select(*columns).collect()}


@pytest.mark.parametrize("compact", [False, True])
def test_run_writes_tables_and_log(spark, tmp_path, compact):
    store, result = rerun(spark, tmp_path, [*MONTHS, {"cancelled": "1"}], compact=compact)
    log = stage_rows(spark, store)
    assert set(log) == {"lookups", "process", "clean", "aggregate", "load", *LOADS}
    assert (log["clean"].records_in, log["clean"].records_out) == (8, 7)
    assert {r.status for r in log.values()} == {"SUCCESS"}
    assert {r.run_id for r in log.values()} == {result.run_id}
    assert log["lookups"].records_in == 4
    assert (log["process"].records_in, log["process"].records_out) == (8, 7)
    assert (log["aggregate"].records_in, log["aggregate"].records_out) == (7, 16)
    hours = store.read(spark, "hourly_features")
    assert sum(r.total_flights for r in hours.collect()) == 7
    assert hours.select("processed_at").distinct().count() == 1


@pytest.mark.parametrize("quarter", [None, "Q4"])
def test_run_without_lake_gives_the_same_tables(spark, tmp_path, quarter):
    _, with_lake = rerun(spark, tmp_path, MONTHS, quarter)
    store, without = rerun(spark, tmp_path / "b", MONTHS, quarter, processed_root=None)
    for name, table in with_lake.tables.items():
        assert rows_of(without.tables[name].drop("processed_at")) == rows_of(
            table.drop("processed_at")
        )
    log = stage_rows(spark, store)
    assert set(log) == {"lookups", "clean", "aggregate", "load", *LOADS}
    assert (log["clean"].records_in, log["clean"].records_out) == (7, 7 if quarter is None else 2)


@pytest.mark.parametrize("lake_root", [True, False])
def test_text_is_read_once(spark, tmp_path, lake_root):
    """Rows that the scan of the file has made, over all jobs of a run."""
    path = str(tmp_path / "trips")
    raw_trips(spark, *MONTHS, *[{"day": str(d)} for d in range(1, 29)]).write.option("header", True).csv(path)
    scanned = spark.sparkContext.accumulator(0)
    trips = read_trips(spark, path)

    def pass_on(batches):
        for batch in batches:
            scanned.add(len(batch))
            yield batch

    watched = trips.mapInPandas(pass_on, trips.schema)
    store = FolderStore(str(tmp_path / "store"))
    root = str(tmp_path / "processed") if lake_root else None
    run(spark, watched, carriers(spark), airports(spark), store, root)
    assert scanned.value == 35
    assert stage_rows(spark, store)["clean"].records_in == 35


def test_a_lake_is_asked_by_its_folders(spark, tmp_path):
    raw = str(tmp_path / "raw")
    from_messages(to_messages(raw_trips(spark, *MONTHS, {"cancelled": "1"}))).write.partitionBy("year", "month").parquet(raw)
    store = FolderStore(str(tmp_path / "store"))
    run(
        spark, read_raw(spark, raw), carriers(spark), airports(spark), store,
        str(tmp_path / "processed"), from_lake=True,
    )
    log = stage_rows(spark, store)
    assert (log["clean"].records_in, log["clean"].records_out, log["process"].records_out) == (8, 7, 7)


def test_run_ignores_partitions_of_earlier_input(spark, tmp_path):
    rerun(spark, tmp_path, [{"year": "2014"}, {"year": "2016"}])
    store, _ = rerun(spark, tmp_path, [{"year": "2015"}])
    assert [r.total_flights for r in store.read(spark, "airline_features").collect()] == [1]
    assert read_processed(spark, str(tmp_path / "processed")).count() == 3


def test_run_of_one_quarter_leaves_the_others(spark, tmp_path):
    store, _ = rerun(spark, tmp_path, MONTHS)
    rerun(spark, tmp_path, [{"month": "1"}, {"month": "5"}], "Q1", store)
    found = {r.quarter: r.total_flights for r in store.read(spark, "airline_features").collect()}
    assert found == {"Q1": 1, "Q2": 1, "Q3": 1, "Q4": 2}


def test_failed_stage_is_logged_and_raised(spark, tmp_path):
    class Broken(FolderStore):
        def replace(self, name, table):
            raise OSError("store is down")

    store = Broken(str(tmp_path / "store"))
    with pytest.raises(OSError, match="store is down"):
        rerun(spark, tmp_path, [{}], store=store)
    rows = {r.stage: r for r in store.read(spark, RUN_LOG).collect()}
    assert (rows["load"].status, rows["load"].error_message) == ("FAILED", "store is down")
    assert rows["aggregate"].status == "SUCCESS"
    assert rows["load"].started_at <= rows["load"].completed_at


def test_serving_read_filters_in_the_store(spark, tmp_path):
    store, _ = rerun(spark, tmp_path, [*MONTHS, {"airline": "BB"}])
    df = lookup_features(spark, store, "airline_features", "Q1", airline="BB")
    assert [r.total_flights for r in df.collect()] == [1]
    plan = plan_of(df)
    assert "EqualTo(airline,BB)" in plan and "PartitionFilters: [isnotnull(quarter" in plan


def rows_read(df) -> int:
    """Rows that the scan has put out, once ``df`` has run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.nodeName().startswith("Adaptive") else plan
    leaf = plan.collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_lookup_by_key_reads_one_row_group(spark, tmp_path):
    """By the sorted key for the first index, by the Bloom filters for the second, whose values lie all
    over the table. Keys that are absent read nothing."""
    store = FolderStore(str(tmp_path / "store"), row_group_bytes=64 << 10)
    n = 60_000
    table = spark.range(n).select(
        F.format_string("R%07d", F.col("id") * 7919 % n).alias("route"),
        F.md5(F.col("id").cast("string")).alias("origin_airport"),
        F.rand(seed=1).alias("delay_rate_pct"),
        F.when(F.col("id") % 3 == 0, "Q2").otherwise("Q1").alias("quarter"),
    )
    assert store.replace("route_features", table.repartition(3)) == n
    one = table.filter("id = 30001").first()
    files = [f for f in (tmp_path / "store" / "route_features" / "quarter=Q1").iterdir() if f.suffix == ".parquet"]
    groups = [pq.ParquetFile(f).metadata for f in files]
    assert sum(g.num_row_groups for g in groups) >= 8
    largest = max(g.row_group(k).num_rows for g in groups for k in range(g.num_row_groups))
    for key in ("route", "origin_airport"):
        found = lookup_features(spark, store, "route_features", "Q1", **{key: one[key]})
        assert [r[key] for r in found.collect()] == [one[key]]
        assert rows_read(found) <= largest
        absent = lookup_features(spark, store, "route_features", "Q1", **{key: one[key] + "x"})
        assert absent.count() == 0 and rows_read(absent) == 0


class Database:
    """Stands for a database: tables of rows, changed for good by a commit."""

    def __init__(self, **tables):
        self.tables, self.fail_after, self.lost = tables, None, 0
        self.options = {}

    def write(self, writer, url, name, mode, properties):
        """Spark's write of a table, which may fail half way."""
        self.options[name] = (mode, properties)
        self.tables[name] = []
        for k, row in enumerate(writer._df.collect()):
            if k == self.fail_after:
                raise OSError("executor lost")
            self.tables[name].append(row.asDict())

    def connect(self, spark, url, properties):
        return Connection(self)


class Connection:
    def __init__(self, database):
        self.database, self.log, self.closed = database, [], False
        self.tables = {name: list(rows) for name, rows in database.tables.items()}

    def setAutoCommit(self, on):
        self.log.append(on)

    def createStatement(self):
        return self

    def executeUpdate(self, sql):
        words = sql.split()
        if words[0] == "DELETE":
            quarter = sql.split("'")[1] if "WHERE" in words else None
            self.tables[words[2]] = [r for r in self.tables[words[2]] if quarter not in (None, r["quarter"])]
        elif words[0] == "INSERT":
            moved = self.tables[words[-1]][self.database.lost :]
            self.tables[words[2]] += moved
            return len(moved)
        else:
            del self.tables[words[2]]
        return 0

    def commit(self):
        assert self.log == [False]
        self.database.tables = self.tables

    def rollback(self):
        self.tables = self.database.tables

    def close(self):
        self.closed = True


@pytest.fixture
def database(monkeypatch):
    stored = [{"airline": "AA", "quarter": q, "total_flights": n} for q, n in (("Q1", 5), ("Q2", 6))]
    found = Database(airline_features=stored)
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda w, url, name, mode, properties: found.write(w, url, name, mode, properties))
    return found


def jdbc(database):
    return JdbcStore("jdbc:postgresql://db/features", {"user": "u", "password": "secret"}, connect=database.connect)


NEW = [("AA", "Q1", 9), ("BB", "Q1", 1), ("CC", "Q2", 2)]
AIRLINES = "airline string, quarter string, total_flights long"


def flights(database):
    return sorted((r["airline"], r["quarter"], r["total_flights"]) for r in database.tables["airline_features"])


def test_jdbc_table_is_exchanged_in_one_transaction(spark, database):
    table = spark.createDataFrame(NEW, AIRLINES)
    store = jdbc(database)
    load_features({"airline_features": table}, store)
    assert flights(database) == NEW and set(database.tables) == {"airline_features"}
    mode, properties = database.options["airline_features_staging"]
    assert mode == "overwrite" and {"batchsize", "numPartitions"} <= properties.keys()
    assert properties["createTableColumnTypes"] == "airline VARCHAR(10), quarter VARCHAR(5)"
    assert "secret" not in repr(store)


def test_jdbc_quarter_keeps_the_others(spark, database):
    assert jdbc(database).replace_quarter("airline_features", spark.createDataFrame(NEW, AIRLINES), "Q1") == 2
    assert flights(database) == [("AA", "Q1", 9), ("AA", "Q2", 6), ("BB", "Q1", 1)]


@pytest.mark.parametrize("fault", [{"fail_after": 2}, {"lost": 1}])
@pytest.mark.parametrize("quarter", [None, "Q1"])
def test_a_load_that_fails_leaves_the_old_rows(spark, database, fault, quarter):
    """The write stops half way, or rows are missing when they are counted in the store."""
    vars(database).update(fault if quarter is None or "lost" in fault else {"fail_after": 1})
    before = flights(database)
    with pytest.raises((OSError, ValueError)):
        load_features({"airline_features": spark.createDataFrame(NEW, AIRLINES)}, jdbc(database), quarter)
    assert flights(database) == before


@pytest.mark.parametrize("name", sorted(TEXT_LENGTHS))
def test_every_declared_text_is_checked(spark, name):
    """Each is written at its full length, and refused one character longer; keys also when null."""
    lengths = TEXT_LENGTHS[name]
    assert {c for c in FEATURE_TABLES[name].keys if c in ("airline", "route", "quarter") or "origin" in c
            or "destination" in c} <= lengths.keys()
    schema = ", ".join(f"{c} string" for c in lengths)
    full = {c: "é" * n for c, n in lengths.items()}
    check_declared(name, spark.createDataFrame([tuple(full.values())], schema))
    for c in lengths:
        long = spark.createDataFrame([tuple((full | {c: full[c] + "x"}).values())], schema)
        with pytest.raises(ValueError, match=f"'{c}': 1"):
            check_declared(name, long)
        null = spark.createDataFrame([tuple((full | {c: None}).values())], schema)
        if c in REQUIRED[name]:
            with pytest.raises(ValueError, match=f"'{c}': 1"):
                check_declared(name, null)
        else:
            check_declared(name, null)


JDBC = JdbcStore("jdbc:postgresql://db/features", {"user": "u", "password": "secret"})


def test_jdbc_log_is_appended(spark):
    with mock.patch.object(DataFrameWriter, "jdbc") as write:
        JDBC.append(RUN_LOG, spark.range(1))
    assert write.call_args.kwargs["mode"] == "append"


def test_folder_tables_round_trip(spark, tmp_path):
    store, result = rerun(spark, tmp_path, MONTHS)
    for name, table in result.tables.items():
        assert rows_of(store.read(spark, name).select(table.columns)) == rows_of(table)


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
@pytest.mark.parametrize("lake", [True, False])
def test_quarter_without_rows_is_emptied(spark, tmp_path, conf, threshold, lake):
    conf(spark__sql__autoBroadcastJoinThreshold=threshold)
    options = {} if lake else {"processed_root": None}
    store, _ = rerun(spark, tmp_path, MONTHS, **options)
    rerun(spark, tmp_path, [{"month": "1", "cancelled": "1"}, {"month": "5"}], "Q1", store, **options)
    for name in FEATURE_TABLES:
        assert {r.quarter for r in store.read(spark, name).collect()} == {"Q2", "Q3", "Q4"}
    if lake:
        left = read_processed(spark, str(tmp_path / "processed"), year=2015)
        assert {r.quarter for r in left.collect()} == {"Q2", "Q3", "Q4"}


def test_run_without_rows_leaves_readable_tables(spark, tmp_path):
    store, _ = rerun(spark, tmp_path, [{"cancelled": "1"}])
    for name in FEATURE_TABLES:
        assert store.read(spark, name).count() == 0
    assert read_processed(spark, str(tmp_path / "processed")).count() == 0


def test_store_is_not_touched_when_a_key_does_not_fit(spark, tmp_path):
    store = JdbcStore("jdbc:none")
    table = spark.createDataFrame([("10397-11298", "Q1"), (None, "Q1")], "route string, quarter string")
    with pytest.raises(ValueError, match="'route': 2"):
        store.replace("route_features", table)
