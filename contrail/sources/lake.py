"""Partitioned Parquet lake: raw messages by month, processed trips by quarter."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.trips import in_quarter
from contrail.schemas import RAW_LAKE
from contrail.sinks.lake import current, read_paths


def read_raw(
    spark: SparkSession,
    root: str,
    year: int | None = None,
    months: tuple[int, ...] | None = None,
    quarter: str | None = None,
) -> DataFrame:
    """Raw trips. All filters are on partition columns: other months are not even listed as input.

    The schema is given, so a lake that holds no data file yet reads as empty. The folders that
    batches of a landing have within a month are not a column.
    """
    df = spark.read.schema(RAW_LAKE).parquet(root).select(RAW_LAKE.names)
    if year is not None:
        df = df.filter(F.col("year") == year)
    if months is not None:
        df = df.filter(F.col("month").isin(*months))
    if quarter is not None:
        df = df.filter(in_quarter(quarter))
    return df


def read_processed(
    spark: SparkSession, root: str, year: int | None = None, quarter: str | None = None
) -> DataFrame:
    """Processed trips as last published. Only the folders of the asked partitions are listed, and the
    schema is the published one. Nothing published is an error."""
    manifest = current(spark, root)
    if manifest is None:
        raise ValueError(f"no processed trips have been published in {root}")
    paths = manifest.paths(root, lambda p: (year in (None, p[0])) and (quarter in (None, p[1])))
    return read_paths(spark, root, paths, T.StructType.fromJson(json.loads(manifest.schema)))
