"""Row-level features."""

from __future__ import annotations

from pyspark.sql import DataFrame

from contrail.functions.casts import int_column
from contrail.functions.trips import CAUSE_FLAGS, cause_flag, cause_total, departure_hour

# The columns of the preview.
PREVIEW_COLUMNS = (
    "airline", "departure_delay", "is_delayed",
    "scheduled_departure_hour", "has_weather_delay", "total_delay_causes_min",
)


def add_departure_hour(df: DataFrame) -> DataFrame:
    hhmm = int_column(df, "scheduled_departure")
    return df.withColumn("scheduled_departure_hour", departure_hour(hhmm))


def add_cause_features(df: DataFrame) -> DataFrame:
    flags = {flag: cause_flag(cause) for flag, cause in CAUSE_FLAGS.items()}
    return df.withColumns({**flags, "total_delay_causes_min": cause_total()})


def engineer_features(df: DataFrame) -> DataFrame:
    return df.transform(add_departure_hour).transform(add_cause_features)


def preview(df: DataFrame) -> DataFrame:
    return df.select(*PREVIEW_COLUMNS)
