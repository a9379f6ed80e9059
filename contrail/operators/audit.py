"""Row counts of stages and the run log."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from contrail.schemas import RUN_AUDIT


def counted(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """``df`` with its rows counted by whichever job runs it next; no job of its own.

    The count is exact when that job writes without a shuffle after this point. Below a shuffle, map
    tasks that are rerun after a lost executor would be counted again.
    """
    seen = Observation(stage)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def observed(seen: Observation) -> dict:
    """What a job has observed. Nothing, if its planner proved some later step empty and dropped the
    steps before it."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


def audit_row(
    run_id: str,
    stage: str,
    status: str,
    quarter: str | None = None,
    records_in: int | None = None,
    records_out: int | None = None,
    started_at: datetime | None = None,
    completed_at: datetime | None = None,
    error_message: str | None = None,
) -> tuple:
    return (
        run_id, quarter, stage, status, records_in, records_out,
        started_at, completed_at, error_message,
    )


def audit_records(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Log records in one partition, in order."""
    return spark.createDataFrame(list(rows), RUN_AUDIT).coalesce(1)
