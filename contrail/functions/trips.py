"""Derived columns of one trip row. Built-ins only, so every one stays in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A trip counts as delayed strictly above this many minutes.
DELAY_THRESHOLD_MIN = 15

# Months of each quarter. Q4 also takes every month outside 1..9, null included.
QUARTER_MONTHS = {"Q1": (1, 2, 3), "Q2": (4, 5, 6), "Q3": (7, 8, 9), "Q4": (10, 11, 12)}

# Flag name and the cause column it looks at (there is no security flag).
CAUSE_FLAGS = {
    "has_weather_delay": "weather_delay",
    "has_carrier_delay": "airline_delay",
    "has_nas_delay": "air_system_delay",
    "has_late_aircraft_delay": "late_aircraft_delay",
}

# The five causes of the total, in the order they are added.
CAUSE_COLUMNS = (
    "weather_delay", "airline_delay", "air_system_delay", "late_aircraft_delay", "security_delay",
)


def is_delayed() -> Column:
    return (F.col("arrival_delay") > DELAY_THRESHOLD_MIN).cast("int")


def quarter_label(month: Column | None = None) -> Column:
    month = F.col("month") if month is None else month
    label = F.when(month.between(1, 3), "Q1").when(month.between(4, 6), "Q2")
    return label.when(month.between(7, 9), "Q3").otherwise("Q4")


def in_quarter(quarter: str) -> Column:
    """The same rule as a predicate on ``month``, so that it can prune month partitions."""
    month = F.col("month")
    if quarter == "Q4":
        return month.isNull() | (month < 1) | (month > 9)
    months = QUARTER_MONTHS[quarter]
    return month.between(months[0], months[-1])


def route_key() -> Column:
    return F.concat("origin_airport", F.lit("-"), "destination_airport")


def departure_hour(hhmm: Column) -> Column:
    """Hour of an HHMM number; 2400 gives 24."""
    return (hhmm / 100).cast("int")


def _minutes(cause: str) -> Column:
    return F.coalesce(F.col(cause), F.lit(0.0).cast("float"))


def cause_flag(cause: str) -> Column:
    return (_minutes(cause) > 0).cast("int")


def cause_total() -> Column:
    first, *rest = CAUSE_COLUMNS
    total = _minutes(first)
    for cause in rest:
        total = total + _minutes(cause)
    return total
