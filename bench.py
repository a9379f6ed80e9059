"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores. The CSV inputs of the three jobs are
written before the clock starts. ``--compare`` also times other ways to build the four tables.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contrail import fixture
from contrail.operators.aggregates import FEATURE_TABLES, aggregate_table
from contrail.operators.clean import clean
from contrail.operators.enrich import Lookups, enrich
from contrail.operators.features import add_departure_hour, engineer_features
from contrail.operators.messages import publish_stats, to_messages
from contrail.plans.batch import run
from contrail.plans.feature_tables import feature_groups, feature_table
from contrail.registry import QUERIES
from contrail.scratch import new_path
from contrail.sinks.lake import write_processed
from contrail.sinks.store import FolderStore
from contrail.sinks.topic import publish
from contrail.sources.files import read_lookup, read_trips
from contrail.sources.lake import read_raw
from contrail.streaming.landing import land, read_topic

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("contrail-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def execute(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(job: Callable[[], object], repeats: int = 2) -> float:
    """Best of ``repeats``."""
    seconds = []
    for _ in range(repeats):
        start = time.perf_counter()
        job()
        seconds.append(time.perf_counter() - start)
    return round(min(seconds), 3)


class Inputs:
    """The trip and lookup files that the jobs read."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        root = new_path(spark, "bench")
        for name in ("raw_trips", "carriers", "airports"):
            frame = getattr(fixture, name)(spark, SF_DIR)
            frame.write.option("header", True).csv(f"{root}/{name}")
        self.trips = read_trips(spark, f"{root}/raw_trips")
        self.carriers = read_lookup(spark, f"{root}/carriers")
        self.airports = read_lookup(spark, f"{root}/airports")

    def lookups(self) -> Lookups:
        return Lookups.measure(self.carriers, self.airports)

    def clean(self) -> DataFrame:
        return self.trips.transform(clean).transform(add_departure_hour)

    def featured(self) -> DataFrame:
        return self.trips.transform(clean).transform(enrich, self.lookups()).transform(
            engineer_features
        )

    def path(self, label: str) -> str:
        return new_path(self.spark, label)


def table_queries(spark: SparkSession) -> dict[str, Callable[[], object]]:
    names = [*FEATURE_TABLES, "feature_tables_together", "airline_features_repeated_codes"]
    names += ["join_carrier", "join_origin", "join_destination", "lookup_unmatched_codes"]
    return {name: lambda name=name: execute(QUERIES[name](spark, SF_DIR)) for name in names}


def job_queries(spark: SparkSession, inputs: Inputs) -> dict[str, Callable[[], object]]:
    topic = inputs.path("topic")
    publish(to_messages(inputs.trips), "parquet", {"path": topic})
    landed = inputs.path("raw")

    def landing(root: str, index: str | None = None, file_bytes: int | None = None) -> None:
        stream = read_topic(spark, "parquet", {"path": topic})
        land(stream, root, inputs.path("checkpoint"), index, file_bytes).awaitTermination()

    landing(landed)

    def whole_run(processed_root: str | None) -> None:
        store = FolderStore(inputs.path("store"))
        run(spark, inputs.trips, inputs.carriers, inputs.airports, store, processed_root)

    def four_tables() -> None:
        for table in feature_groups(inputs.clean(), inputs.lookups()).tables().values():
            execute(table)

    return {
        "csv_clean": lambda: execute(inputs.trips.transform(clean)),
        "csv_enrich_features": lambda: execute(inputs.featured()),
        "csv_four_tables": four_tables,
        "csv_write_processed": lambda: write_processed(inputs.featured(), inputs.path("processed")),
        "csv_run": lambda: whole_run(inputs.path("processed")),
        "csv_run_tables_only": lambda: whole_run(None),
        "csv_publish": lambda: publish(
            to_messages(inputs.trips), "parquet", {"path": inputs.path("topic")}
        ),
        "csv_publish_stats": lambda: publish_stats(inputs.trips).collect(),
        "land": lambda: landing(inputs.path("raw")),
        "land_drop_repeats": lambda: landing(inputs.path("raw"), inputs.path("seen")),
        "land_sized": lambda: landing(inputs.path("raw"), file_bytes=32_000_000),
        "lake_quarter": lambda: execute(
            feature_table(
                read_raw(spark, landed, quarter="Q2").transform(clean),
                inputs.lookups(),
                "airline_features",
            )
        ),
    }


def compare_plans(inputs: Inputs) -> dict[str, float]:
    """Ways to build all four tables from the CSV file, and to run the whole job."""

    def run_uncached() -> None:
        """The job as a sequence of 18 actions over uncached frames, each from the file again."""
        store = FolderStore(inputs.path("store"))
        cleaned, featured = inputs.trips.transform(clean), inputs.featured()
        for frame in (inputs.trips, cleaned, cleaned, inputs.featured(), featured):
            frame.count()
        featured.take(5)
        for name in FEATURE_TABLES:
            table = aggregate_table(featured, name)
            table.take(3)
            table.count()
            store.replace(name, table)

    def run_tables_only() -> None:
        store = FolderStore(inputs.path("store"))
        run(inputs.spark, inputs.trips, inputs.carriers, inputs.airports, store)

    def together() -> None:
        for table in feature_groups(inputs.clean(), inputs.lookups()).tables().values():
            execute(table)

    def each_by_code() -> None:
        lookups = inputs.lookups()
        for name in FEATURE_TABLES:
            execute(feature_table(inputs.clean(), lookups, name))

    def each_joined_first() -> None:
        for name in FEATURE_TABLES:
            execute(aggregate_table(inputs.featured(), name))

    def persisted() -> None:
        kept = inputs.featured().persist()
        for name in FEATURE_TABLES:
            execute(aggregate_table(kept, name))
        kept.unpersist(blocking=True)

    ways = (
        together, each_by_code, each_joined_first, persisted, run_tables_only, run_uncached,
    )
    return {way.__name__: timed(way) for way in ways}


def main() -> None:
    spark = session()
    inputs = Inputs(spark)
    if "--compare" in sys.argv:
        print(json.dumps(compare_plans(inputs)))
        return
    jobs = {**table_queries(spark), **job_queries(spark, inputs)}
    seconds = {name: timed(job) for name, job in jobs.items()}
    total = round(sum(seconds.values()), 3)
    scale = SF_DIR.rsplit("/", 1)[-1].removeprefix("sf")
    print(
        json.dumps(
            {"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds,
             "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
