"""Typing, filtering and labelling of raw trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.casts import as_float, int_column
from contrail.functions.trips import in_quarter, is_delayed, quarter_label, route_key
from contrail.schemas import CALENDAR_COLUMNS, MEASURE_COLUMNS


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def cast_measures(df: DataFrame) -> DataFrame:
    """Measures to float; one that the input lacks is left out."""
    return df.withColumns({c: as_float(c) for c in MEASURE_COLUMNS if c in df.columns})


def cast_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns({c: int_column(df, c) for c in CALENDAR_COLUMNS})


def keep_operated(df: DataFrame) -> DataFrame:
    """Drops cancelled trips, and those whose flag is null or written otherwise than ``0``."""
    return df.filter(F.col("cancelled") == "0")


def keep_measured(df: DataFrame) -> DataFrame:
    """Drops trips without a usable delay. Spelled out because ``dropna`` is not pushed to scans."""
    for c in ("arrival_delay", "departure_delay"):
        df = df.filter(F.col(c).isNotNull() & ~F.isnan(c))
    return df


def label_trips(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"is_delayed": is_delayed(), "quarter": quarter_label(), "route": route_key()}
    )


def select_quarter(df: DataFrame, quarter: str | None) -> DataFrame:
    """Rows of one quarter, by month; all rows without a quarter."""
    return df if quarter is None else df.filter(in_quarter(quarter))


def clean(df: DataFrame) -> DataFrame:
    return (
        df.transform(lower_names)
        .transform(cast_measures)
        .transform(cast_calendar)
        .transform(keep_operated)
        .transform(keep_measured)
        .transform(label_trips)
    )
