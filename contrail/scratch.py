"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from contrail.files import remove, sizes

# Of Parquet that grows with the input. Half the size of the session's default, or less.
LEAN = {"compression": "zstd"}
_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# A table is shuffled in slices of this much of its files, or in this many if that makes them larger.
SLICE_BYTES = 512 << 20
MOST_SLICES = 16

# The paths made since each open ``temporary`` block began, innermost last.
_blocks: list[list[str]] = []


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="contrail-")


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``. Only a local session may go without: it gets a
    temporary folder, which the executors of a cluster could not see."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = _local_folder()
    return configured.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if _blocks:
        _blocks[-1].append(path)
    return path


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables that are written inside the block are removed at its end, also after a failure. What is
    to last must be written to a path made before."""
    _blocks.append([])
    try:
        yield
    finally:
        for path in _blocks.pop():
            remove(spark, path)


def in_pieces(spark: SparkSession, split_bytes: int) -> SparkSession:
    """A session with the same options whose tasks read files in pieces of at most ``split_bytes``. Text
    is many times larger in memory than in a Parquet file, and a task holds what it deals to others."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    return own


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written inside the block leaves no shuffle files: they go when their job has ended, not
    when the driver happens to collect its garbage. Not for a DataFrame that is collected twice."""
    before = spark.conf.get(_REMOVE_SHUFFLES, None)
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_REMOVE_SHUFFLES) if before is None else spark.conf.set(_REMOVE_SHUFFLES, before)


def staged(df: DataFrame, label: str, partition_by: Sequence[str] = (), path: str | None = None) -> DataFrame:
    """As :func:`materialise`, for tables that grow with the input: with less disk, for more time."""
    path = path or new_path(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        df.write.options(**LEAN).parquet(path, partitionBy=list(partition_by) or None)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns)


def slices(spark: SparkSession, path: str, columns: Sequence[str], split: bool = False) -> list[list[str]]:
    """The folders of a table that was written by ``columns``, in groups. A job per group has the shuffle
    files of one group on disk, not of all. A folder that is larger than a group is one of its own, or
    with ``split`` as many as its files call for."""
    found = sizes(spark, "/".join([path, *[f"{c}=*" for c in columns]]))
    most = max(SLICE_BYTES, -(-sum(n for _, n in found) // MOST_SLICES))
    if split:
        found = [part for own in found for part in ([own] if own[1] <= most else sizes(spark, f"{own[0]}/part-*"))]
    groups, size = [], 0
    for part, n in found:
        if not groups or size + n > most:
            groups.append([])
            size = 0
        groups[-1].append(part)
        size += n
    return groups


def in_slices(df: DataFrame, label: str, columns: Sequence[str], session: SparkSession, split: bool = False) -> Iterator[DataFrame]:
    """``df``, written once by ``columns`` without a shuffle, as the tables of its :func:`slices`, at
    least one; ``session`` reads them. The files of each are removed when the next one is asked for."""
    spark, path = df.sparkSession, new_path(df.sparkSession, label)
    staged(df, label, columns, path)
    reader = session.read.schema(df.schema).option("basePath", path)
    groups = slices(spark, path, columns, split)
    for group in groups:
        yield reader.parquet(*group).select(df.columns)
        for part in group:
            remove(spark, part)
    if not groups:
        yield session.createDataFrame([], df.schema)


def materialise(
    df: DataFrame, label: str, partition_by: str | None = None, path: str | None = None
) -> DataFrame:
    """Writes ``df`` once and reads it back: later steps neither recompute it nor depend on the
    executors that made it."""
    path = path or new_path(df.sparkSession, label)
    df.write.parquet(path, partitionBy=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)
