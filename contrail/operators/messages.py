"""Trips as keyed JSON messages, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.casts import as_int
from contrail.operators.clean import lower_names
from contrail.schemas import MESSAGE_VALUE, TRIP_COLUMNS


# What stands in the key for a column that the input lacks (not for a blank one).
KEY_DEFAULTS = {"airline": "X", "flight_number": "0", "year": "2015", "month": "01", "day": "01"}


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _present(trips: DataFrame, name: str) -> Column:
    """The column as text, blank where missing; null when the input has no such column."""
    return _text(name) if name in trips.columns else F.lit(None).cast("string")


def publishable(trips: DataFrame) -> Column:
    """A trip is published when it has a flight number and a departure time; blank is missing. Input
    that lacks one of these columns altogether has no trip to publish."""
    needed = ("flight_number", "departure_time")
    if not set(needed) <= set(trips.columns):
        return F.lit(False)
    return (_text("flight_number") != "") & (_text("departure_time") != "")


def keep_publishable(trips: DataFrame) -> DataFrame:
    return trips.filter(publishable(trips))


def message_key(trips: DataFrame) -> Column:
    """``airline-flight-YYYYMMDD`` without padding. Equal keys share a topic partition."""
    part = {c: F.coalesce(_present(trips, c), F.lit(KEY_DEFAULTS[c])) for c in KEY_DEFAULTS}
    dash = F.lit("-")
    date = (part["year"], part["month"], part["day"])
    return F.concat(part["airline"], dash, part["flight_number"], dash, *date)


def message_value(trips: DataFrame, ingested_at: Column) -> Column:
    """JSON object of all trip columns as text plus the ingestion time."""
    fields = [_present(trips, c).alias(c) for c in TRIP_COLUMNS]
    payload = F.struct(*fields, ingested_at.alias("ingested_at"))
    return F.to_json(payload, {"ignoreNullFields": "false"})


def utc_now() -> Column:
    """Ingestion time as ISO text."""
    return F.date_format(
        F.convert_timezone(None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz")),
        "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    )


def to_messages(trips: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """One ``key``, ``value`` row per publishable trip, stamped with the current time by default."""
    trips = trips.transform(lower_names)
    value = message_value(trips, utc_now() if ingested_at is None else F.lit(ingested_at))
    return trips.transform(keep_publishable).select(
        message_key(trips).alias("key"), value.alias("value")
    )


def from_messages(messages: DataFrame, carry: Sequence[Column] = ()) -> DataFrame:
    """Raw lake rows, and the columns ``carry``. A message that cannot be read keeps its text. Blanks
    become null again, as in the file, and year and month become ints."""
    kept = {"columnNameOfCorruptRecord": "corrupt_value"}
    parsed = messages.select(
        F.from_json(F.col("value").cast("string"), MESSAGE_VALUE, kept).alias("value"),
        F.col("key").cast("string").alias("message_key"),
        F.struct(F.lit(0).alias("none"), *carry).alias("carried"),
    ).select("value.*", "message_key", "carried")
    typed = ("year", "month", "message_key", "corrupt_value", "carried")
    texts = [c for c in parsed.columns if c not in typed]
    return parsed.select(
        *[F.nullif(F.col(c), F.lit("")).alias(c) for c in texts],
        "corrupt_value",
        "message_key",
        as_int("year").alias("year"),
        as_int("month").alias("month"),
        "carried.*",
    ).drop("none")


def publish_stats(trips: DataFrame) -> DataFrame:
    """Rows read, published and skipped, in one pass."""
    trips = trips.transform(lower_names)
    published = publishable(trips)
    return trips.agg(
        F.count("*").alias("total_rows"),
        F.count_if(published).alias("published"),
        F.count_if(~published).alias("skipped"),
    )
