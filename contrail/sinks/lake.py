"""Processed trips by year and quarter, published by a manifest.

A write adds a folder of its own version to every quarter that it reaches. What readers see is the last
manifest, which names one version per quarter: it is written last and as a whole, so a run that fails,
wherever it does, changes nothing, and a run that replaces many quarters replaces them together. A
quarter that has no trips any more is left out of the manifest, without a job of its own.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.files import matching, read_text, remove, write_new
from contrail.functions.casts import int_column
from contrail.functions.trips import quarter_label
from contrail.operators.audit import observed
from contrail.operators.clean import lower_names
from contrail.scratch import LEAN, shuffles_removed

MOST_PARTITIONS = 10_000
VERSION = "version"

Partition = tuple[int | None, str]

_NO_YEAR = 1 << 40
# Years that are observed while a run reads its input. Others, in dirty text, are asked for separately.
_YEARS = (0, 2500)


def _number(year: Column, quarter: Column) -> Column:
    """A number per partition: collecting numbers costs a fraction of collecting structs."""
    return F.coalesce(year.cast("long"), F.lit(_NO_YEAR)) * 10 + F.substring(quarter, 2, 1).cast("int")


def _partitions(numbers: Collection[int]) -> list[Partition]:
    found = [divmod(n, 10) for n in sorted(numbers)]
    return [(None if year == _NO_YEAR else year, f"Q{quarter}") for year, quarter in found]


@dataclass(frozen=True)
class Written:
    """What a write did: its version, its rows, and the partitions that have rows in it."""

    version: str
    rows: int
    partitions: list[Partition]

    @property
    def versions(self) -> dict[Partition, str]:
        return dict.fromkeys(self.partitions, self.version)


@dataclass(frozen=True)
class WrittenApart:
    """Writes that have no partition in common, to be published as one."""

    parts: list[Written]

    @property
    def rows(self) -> int:
        return sum(part.rows for part in self.parts)

    @property
    def versions(self) -> dict[Partition, str]:
        return {partition: part.version for part in self.parts for partition in part.partitions}


@dataclass(frozen=True)
class Manifest:
    """The version of each partition, and the schema of the rows. Versions of manifests are numbered."""

    number: int
    schema: str
    versions: dict[Partition, str]

    def paths(self, root: str, keep: Callable[[Partition], bool] = lambda partition: True) -> list[str]:
        return [
            f"{root}/year={'__HIVE_DEFAULT_PARTITION__' if p[0] is None else p[0]}/quarter={p[1]}/{VERSION}={v}"
            for p, v in self.versions.items()
            if keep(p)
        ]


def _manifests(spark: SparkSession, root: str) -> list[str]:
    return sorted(matching(spark, f"{root}/_manifests/*.json"))


def _read(spark: SparkSession, path: str) -> Manifest:
    found = json.loads(read_text(spark, path))
    versions = {(year, quarter): version for year, quarter, version in found["versions"]}
    return Manifest(int(path.rsplit("/", 1)[1].removesuffix(".json")), found["schema"], versions)


def current(spark: SparkSession, root: str) -> Manifest | None:
    """The manifest in force; None if nothing was ever published."""
    found = _manifests(spark, root)
    return _read(spark, found[-1]) if found else None


def publish(
    spark: SparkSession,
    root: str,
    written: Written | WrittenApart,
    schema: T.StructType,
    touched: Collection[Partition],
) -> Manifest:
    """Puts a version in force for its partitions, and drops those of ``touched`` that it has no rows
    for. If another run publishes at the same time, one of them goes on from the other's manifest."""
    while True:
        before = current(spark, root)
        versions = {} if before is None else dict(before.versions)
        for partition in touched:
            versions.pop(partition, None)
        versions |= written.versions
        number = 1 if before is None else before.number + 1
        found = Manifest(number, schema.json(), versions)
        rows = [[*partition, version] for partition, version in sorted(versions.items(), key=str)]
        text = json.dumps({"schema": found.schema, "versions": rows})
        if write_new(spark, f"{root}/_manifests/{number:09d}.json", text):
            return found


def remove_old_versions(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Removes the folders that none of the last ``keep`` manifests names and that an older one does, and
    the older manifests. Readers that started under a kept manifest are not disturbed, nor is a write
    under way. Returns the number of folders."""
    found = _manifests(spark, root)
    old, kept = found[:-keep], found[-keep:]
    used = {path for m in kept for path in _read(spark, m).paths(root)}
    gone = {path for m in old for path in _read(spark, m).paths(root)} - used
    for path in [*sorted(gone), *old]:
        remove(spark, path)
    return len(gone)


def covered(raw: DataFrame, quarter: str | None = None) -> tuple[int, set[Partition]]:
    """Rows of raw trips, and the partitions that they cover, cancelled trips included.

    A job of its own over two columns, for a lake, of which these are partition columns. Dirty year
    text cannot flood the driver: beyond ``MOST_PARTITIONS`` it is an error.
    """
    raw = raw.transform(lower_names)
    dated = raw.select(*[int_column(raw, c).alias(c) for c in ("year", "month")])
    counts = dated.groupBy("year", quarter_label().alias("quarter")).count()
    found = counts.limit(MOST_PARTITIONS + 1).collect()
    if len(found) > MOST_PARTITIONS:
        raise ValueError(f"the trips cover more than {MOST_PARTITIONS} years and quarters")
    touched = {(r["year"], r["quarter"]) for r in found}
    return sum(r["count"] for r in found), {t for t in touched if quarter in (None, t[1])}


class Coverage:
    """What :func:`covered` tells, observed while a job reads the raw trips: for text, which would
    otherwise be parsed twice. Known once that job has run."""

    def __init__(self) -> None:
        self.seen = Observation()

    def watch(self, raw: DataFrame) -> DataFrame:
        named = raw.transform(lower_names)
        year, month = (int_column(named, c) for c in ("year", "month"))
        usual = year.isNull() | year.between(*_YEARS)
        number = _number(year, quarter_label(month))
        return named.observe(
            self.seen,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(~usual).alias("unusual"),
            F.collect_set(F.when(usual, number)).alias("numbers"),
        )

    def found(self, raw: DataFrame, quarter: str | None) -> tuple[int, set[Partition]]:
        """Years far off, which only dirty text has, are too many to observe: then ``raw`` is asked, as
        it is if nothing was observed because no row came out in the end."""
        seen = observed(self.seen)
        if not seen or seen["unusual"]:
            return covered(raw, quarter)
        touched = _partitions(seen["numbers"])
        return seen["rows"], {t for t in touched if quarter in (None, t[1])}


def by_partition(trips: DataFrame) -> DataFrame:
    """``trips`` redistributed by partition; adaptive execution splits the large ones."""
    return trips.hint("rebalance", "year", "quarter")


def write_version(trips: DataFrame, root: str, compact: bool = True) -> Written:
    """Writes ``trips`` where no reader looks yet.

    ``compact`` redistributes the rows by partition, and adaptive execution splits the large
    partitions into files of its advisory size: no task adds a file to every partition, and a
    quarter that holds most rows is not written by one task. For input laid out by date, which
    reaches few partitions per task, the shuffle can be left out, as for trips that went through
    :func:`by_partition` before.

    The observed rows are counted in the tasks that write, after any shuffle.
    """
    placed = by_partition(trips) if compact else trips
    seen, version = Observation(), uuid.uuid4().hex
    number = _number(F.col("year"), F.col("quarter"))
    writer = (
        placed.withColumn(VERSION, F.lit(version))
        .observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(number).alias("partitions"))
        .write.mode("append")
        .options(**LEAN)
        .partitionBy("year", "quarter", VERSION)
    )
    with shuffles_removed(trips.sparkSession):
        writer.parquet(root)
    found = observed(seen)
    return Written(version, found.get("rows", 0), _partitions(found.get("partitions", ())))


def read_version(
    spark: SparkSession, root: str, written: Written | WrittenApart, schema: T.StructType
) -> DataFrame:
    """The rows of one write, published or not."""
    return read_paths(spark, root, Manifest(0, "", written.versions).paths(root), schema)


def read_paths(spark: SparkSession, root: str, paths: list[str], schema: T.StructType) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).option("basePath", root).parquet(*paths)
    return found.select(schema.names)


def write_processed(
    trips: DataFrame, root: str, compact: bool = True, touched: Collection[Partition] = ()
) -> Written:
    """Replaces the partitions that ``trips`` has rows for, and empties the others of ``touched``."""
    written = write_version(trips, root, compact)
    publish(trips.sparkSession, root, written, trips.schema, touched)
    return written
