"""The quarterly run: raw trips to processed lake, feature tables, store and run log."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession

from contrail.operators.audit import audit_records, audit_row, counted, observed
from contrail.operators.clean import clean, select_quarter
from contrail.operators.enrich import Lookups, enrich
from contrail.operators.features import add_departure_hour, engineer_features
from contrail.plans.feature_tables import feature_groups
from contrail.scratch import in_slices, temporary
from contrail.sinks.lake import (
    Coverage,
    Written,
    WrittenApart,
    by_partition,
    covered,
    publish,
    read_version,
    write_version,
)
from contrail.sinks.store import FeatureStore, load_table

RUN_LOG = "pipeline_runs"


class Stage:
    """What a stage reports: rows in and out, known once its job has run."""

    def __init__(self) -> None:
        self.records_in: int | None = None
        self.records_out: int | None = None


@dataclass(frozen=True)
class RunLog:
    """A record per stage, also of one that fails. Records are appended together: at the end of the run
    or after a failure, and whenever :meth:`flush` is called."""

    spark: SparkSession
    store: FeatureStore
    run_id: str
    quarter: str | None
    waiting: list[tuple] = field(default_factory=list)

    @contextmanager
    def stage(self, name: str) -> Iterator[Stage]:
        stage, started = Stage(), datetime.now(UTC)
        try:
            yield stage
        except Exception as error:
            self._add(name, "FAILED", stage, started, str(error))
            try:
                self.flush()
            except Exception as second:  # the error of the stage is the one to raise
                error.add_note(f"the failure could not be logged: {second}")
            raise
        self._add(name, "SUCCESS", stage, started, None)

    def add(self, name: str, started: datetime, records_in: int, records_out: int) -> None:
        """A stage that ran inside the job of another."""
        stage = Stage()
        stage.records_in, stage.records_out = records_in, records_out
        self._add(name, "SUCCESS", stage, started, None)

    def _add(
        self, name: str, status: str, stage: Stage, started: datetime, error: str | None
    ) -> None:
        self.waiting.append(
            audit_row(
                self.run_id, name, status, self.quarter, stage.records_in, stage.records_out,
                started, datetime.now(UTC), error,
            )
        )

    def flush(self) -> None:
        """In order, in one task; a flush that fails may be tried again."""
        if self.waiting:
            self.store.append(RUN_LOG, audit_records(self.spark, self.waiting))
            self.waiting.clear()


@dataclass(frozen=True)
class RunResult:
    run_id: str
    tables: dict[str, DataFrame]


def rows_seen(observation: Observation) -> int:
    """No count means that the planner has proven that nothing comes out."""
    return observed(observation).get("rows", 0)


def run(
    spark: SparkSession,
    raw_trips: DataFrame,
    carriers: DataFrame,
    airports: DataFrame,
    store: FeatureStore,
    processed_root: str | None = None,
    quarter: str | None = None,
    processed_at: datetime | None = None,
    compact: bool = True,
    from_lake: bool = False,
) -> RunResult:
    """Jobs: one over the lookups, one that reads the raw trips and writes the clean ones by partition to
    a table of the run, one for each slice of that table, which writes the processed lake, one that groups
    the trips, and the small writes of tables and log. ``compact`` may be off for raw input in date order
    (see :func:`write_version`); if the names need no shuffle either, the lake is written at once.

    A run replaces what its input covers: a quarter whose trips have all gone is emptied. Raw text is
    read and parsed once; its rows, clean rows and covered quarters are observed on the way. With
    ``from_lake`` the raw trips lie by year and month, and what they cover is asked of these folders
    and of the file footers first, so that filters reach the scan.

    Observed counts are exact but for executors that are lost between a map task and its readers:
    rows that are read again are counted again. The covered quarters are a set, and stay right.

    The groups are read from the partitions just written, which are columnar, typed and durable:
    nothing is cached, and a lost executor costs no second parse. They are published before.
    Without ``processed_root`` no lake is written and the raw trips are grouped as they are read.
    """
    log = RunLog(spark, store, uuid.uuid4().hex, quarter)
    stamp = processed_at or datetime.now(UTC)

    with log.stage("lookups") as stage:
        lookups = Lookups.measure(carriers, airports)
        stage.records_in = stage.records_out = lookups.rows

    coverage, started = Coverage(), datetime.now(UTC)
    watched = raw_trips if from_lake else coverage.watch(raw_trips)
    cleaned, clean_rows = counted(watched.transform(clean).transform(select_quarter, quarter), "clean")

    def coverage_of_input() -> tuple[int, set]:
        return covered(raw_trips, quarter) if from_lake else coverage.found(raw_trips, quarter)

    if processed_root is None:
        trips = cleaned.transform(add_departure_hour)
    else:
        with log.stage("process") as stage:
            # Where names are broadcast they need no shuffle, so the rows are dealt before they get any.
            broadcast = lookups.broadcast(spark)
            early = compact and broadcast

            def written_of(trips: DataFrame) -> Written:
                dealt = by_partition(trips) if early else trips
                named = dealt.transform(enrich, lookups).transform(engineer_features)
                return write_version(named, processed_root, compact and not early)

            if broadcast and not compact:
                written = written_of(cleaned)
            else:  # with a shuffle, of some partitions at a time
                with temporary(spark):
                    parts = in_slices(cleaned, "cleaned", ("year", "quarter"), spark)
                    written = WrittenApart([written_of(part) for part in parts])
            featured = cleaned.transform(enrich, lookups).transform(engineer_features)
            stage.records_in, touched = coverage_of_input()
            publish(spark, processed_root, written, featured.schema, touched)
            stage.records_out = written.rows
        log.add("clean", started, stage.records_in, rows_seen(clean_rows))
        log.flush()
        trips = read_version(spark, processed_root, written, featured.schema)

    with log.stage("aggregate") as stage:
        groups = feature_groups(trips, lookups)
        sizes, trip_count = groups.sizes()
        stage.records_in, stage.records_out = trip_count, sum(sizes.values())
    if processed_root is None:
        raw_rows, _ = coverage_of_input()
        log.add("clean", started, raw_rows, rows_seen(clean_rows))

    with log.stage("load") as stage:
        stage.records_in, stored = sum(sizes.values()), 0
        for name, table in groups.tables(stamp).items():
            with log.stage(f"load_{name}") as own:
                own.records_in = sizes.get(name, 0)
                own.records_out = load_table(name, table, store, quarter)
                stored += own.records_out
        stage.records_out = stored

    log.flush()
    return RunResult(log.run_id, groups.tables(stamp))
