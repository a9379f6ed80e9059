"""CSV inputs. A missing path fails when the plan is analysed, before any task starts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from contrail.schemas import RAW_TRIPS


def read_trips(spark: SparkSession, path: str, schema: T.StructType | None = RAW_TRIPS) -> DataFrame:
    """The trip file or files, every column as text.

    The header of each file is checked against the schema, so a file with other columns is an error
    and not shifted data. ``schema=None`` takes the names from the first header: for files that lack
    columns or order them differently.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        schema = reader.option("inferSchema", False).csv(path).schema
    return reader.option("enforceSchema", False).schema(schema).csv(path)


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """A lookup file, names from its header in lower case, every column as text."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return df.toDF(*[c.lower() for c in df.columns])
