"""Column lists and schemas of the inputs, the lake and the feature store."""

from __future__ import annotations

from pyspark.sql import types as T

# The 31 columns of the trip file, in file order.
TRIP_COLUMNS = (
    "year", "month", "day", "day_of_week",
    "airline", "flight_number", "tail_number",
    "origin_airport", "destination_airport",
    "scheduled_departure", "departure_time", "departure_delay",
    "taxi_out", "wheels_off", "scheduled_time", "elapsed_time", "air_time", "distance",
    "wheels_on", "taxi_in", "scheduled_arrival", "arrival_time", "arrival_delay",
    "diverted", "cancelled", "cancellation_reason",
    "air_system_delay", "security_delay", "airline_delay", "late_aircraft_delay", "weather_delay",
)

# Columns that become 32-bit floats, and columns that become ints.
MEASURE_COLUMNS = (
    "departure_delay", "arrival_delay", "air_time", "distance", "taxi_out", "taxi_in",
    "elapsed_time", "scheduled_time", "air_system_delay", "security_delay",
    "airline_delay", "late_aircraft_delay", "weather_delay",
)
CALENDAR_COLUMNS = ("year", "month", "day", "day_of_week")

# What makes two messages the same trip: the message key alone is ambiguous (it has no route, no
# departure time and no padding in the date).
IDENTITY_COLUMNS = (
    "year", "month", "day", "airline", "flight_number",
    "origin_airport", "destination_airport", "scheduled_departure",
)


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


RAW_TRIPS = _strings(n.upper() for n in TRIP_COLUMNS)

# A message that is no JSON keeps its text in the last column.
MESSAGE_VALUE = _strings((*TRIP_COLUMNS, "ingested_at", "corrupt_value"))
MESSAGE_TOPIC = _strings(("key", "value"))

# The raw lake holds the messages as text; only its two partition columns are typed.
RAW_LAKE = T.StructType(
    [f for f in MESSAGE_VALUE if f.name not in ("year", "month")]
    + [
        T.StructField("message_key", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
    ]
)

RUN_AUDIT = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("quarter", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("records_in", T.LongType()),
        T.StructField("records_out", T.LongType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("completed_at", T.TimestampType()),
        T.StructField("error_message", T.StringType()),
    ]
)
