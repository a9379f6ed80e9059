"""Hand-made trips and lookups."""

from __future__ import annotations

from contrail.schemas import TRIP_COLUMNS

ON_TIME = {
    "year": "2015", "month": "1", "day": "4", "day_of_week": "7",
    "airline": "AA", "flight_number": "98", "tail_number": "N1",
    "origin_airport": "SEA", "destination_airport": "CLT",
    "scheduled_departure": "0955", "departure_time": "1001", "departure_delay": "6",
    "taxi_out": "16", "scheduled_time": "300", "elapsed_time": "290", "air_time": "270",
    "distance": "2279", "taxi_in": "4", "arrival_delay": "-3", "diverted": "0", "cancelled": "0",
}
TEXT_TRIP = ", ".join(f"{c} string" for c in TRIP_COLUMNS)


def raw_trips(spark, *changes: dict):
    """One text row per dict of differences from an on-time trip."""
    rows = [tuple({**ON_TIME, **change}.get(c) for c in TRIP_COLUMNS) for change in changes]
    return spark.createDataFrame(rows, TEXT_TRIP)


def carriers(spark, *rows):
    return spark.createDataFrame(list(rows) or [("AA", "First Air"), ("BB", "Second Air")],
                                 "iata_code string, airline string")


def airports(spark, *rows):
    default = [
        ("SEA", "Sea Field", "Seaton", "WA", "47.4", "-122.3"),
        ("CLT", "Clay Field", "Clayton", "NC", "35.2", "bad"),
    ]
    names = ("iata_code", "airport", "city", "state", "latitude", "longitude")
    return spark.createDataFrame(list(rows) or default, ", ".join(f"{n} string" for n in names))


def rows_of(df):
    """Rows as sorted text, so nulls and floats compare plainly."""
    return sorted(repr(tuple(r)) for r in df.collect())
