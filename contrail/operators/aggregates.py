"""The four feature tables: per carrier, route, origin airport and hour, each per quarter.

All measures are sums, counts, means and one standard deviation, so every table is combined in the
map tasks before its shuffle: a task sends one row per group however often a key repeats.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _mean(name: str) -> Column:
    return F.round(F.mean(name), 2)


def _measures() -> dict[str, Column]:
    """Every measure once, under a neutral name; the tables rename the ones they show."""
    return {
        "trips": F.count("*"),
        "delayed": F.sum("is_delayed"),
        "delay_rate": F.round(F.sum("is_delayed") / F.count("*") * 100, 2),
        "mean_arrival_delay": _mean("arrival_delay"),
        "std_arrival_delay": F.round(F.stddev_samp("arrival_delay"), 2),
        "mean_departure_delay": _mean("departure_delay"),
        "mean_weather_delay": _mean("weather_delay"),
        "mean_airline_delay": _mean("airline_delay"),
        "mean_system_delay": _mean("air_system_delay"),
        "mean_distance": _mean("distance"),
        "mean_air_time": _mean("air_time"),
        "mean_taxi_out": _mean("taxi_out"),
    }


@dataclass(frozen=True)
class FeatureTable:
    """``keys`` in output order; ``codes`` are those that the unenriched trips hold."""

    keys: tuple[str, ...]
    codes: tuple[str, ...]
    measures: Mapping[str, str]


# Group keys, output columns and their order. The airport table's rate is the share
# of departures that arrived late: it counts the same flag as the other tables.
FEATURE_TABLES: dict[str, FeatureTable] = {
    "airline_features": FeatureTable(
        keys=("airline", "airline_name", "quarter"),
        codes=("airline", "quarter"),
        measures={
            "total_flights": "trips",
            "delayed_flights": "delayed",
            "avg_arrival_delay_min": "mean_arrival_delay",
            "avg_departure_delay_min": "mean_departure_delay",
            "std_arrival_delay": "std_arrival_delay",
            "delay_rate_pct": "delay_rate",
            "avg_weather_delay_min": "mean_weather_delay",
            "avg_carrier_delay_min": "mean_airline_delay",
            "avg_nas_delay_min": "mean_system_delay",
        },
    ),
    "route_features": FeatureTable(
        keys=(
            "route", "origin_airport", "destination_airport",
            "origin_city", "destination_city", "quarter",
        ),
        codes=("origin_airport", "destination_airport", "quarter"),
        measures={
            "total_flights": "trips",
            "delayed_flights": "delayed",
            "avg_arrival_delay_min": "mean_arrival_delay",
            "avg_departure_delay_min": "mean_departure_delay",
            "delay_rate_pct": "delay_rate",
            "avg_distance_miles": "mean_distance",
            "avg_air_time_min": "mean_air_time",
        },
    ),
    "airport_features": FeatureTable(
        keys=("origin_airport", "origin_airport_name", "origin_city", "origin_state", "quarter"),
        codes=("origin_airport", "quarter"),
        measures={
            "total_departures": "trips",
            "delayed_departures": "delayed",
            "avg_departure_delay_min": "mean_departure_delay",
            "departure_delay_rate_pct": "delay_rate",
            "avg_taxi_out_min": "mean_taxi_out",
        },
    ),
    "hourly_features": FeatureTable(
        keys=("scheduled_departure_hour", "day_of_week", "quarter"),
        codes=("scheduled_departure_hour", "day_of_week", "quarter"),
        measures={
            "total_flights": "trips",
            "delayed_flights": "delayed",
            "avg_arrival_delay_min": "mean_arrival_delay",
            "delay_rate_pct": "delay_rate",
        },
    ),
}


def aggregate_table(trips: DataFrame, name: str, keys: tuple[str, ...] | None = None) -> DataFrame:
    """One table from enriched trips, or from unenriched ones when ``keys`` are its codes."""
    table = FEATURE_TABLES[name]
    measures = _measures()
    return trips.groupBy(*(keys or table.keys)).agg(
        *[measures[source].alias(shown) for shown, source in table.measures.items()]
    )


def stamped(table: DataFrame, processed_at: datetime) -> DataFrame:
    return table.withColumn("processed_at", F.lit(processed_at))


def aggregate_features(
    trips: DataFrame, processed_at: datetime | None = None
) -> dict[str, DataFrame]:
    """All four tables of enriched trips, each a plan of its own."""
    tables = {name: aggregate_table(trips, name) for name in FEATURE_TABLES}
    if processed_at is None:
        return tables
    return {name: stamped(table, processed_at) for name, table in tables.items()}


def aggregate_together(trips: DataFrame, keysets: Mapping[str, tuple[str, ...]]) -> DataFrame:
    """All tables in one pass over the trips: one scan and one shuffle of combined rows.

    The result holds the rows of every table, told apart by ``feature_table``. Null codes stay
    apart from the codes that a table does not group by, since the grouping id is a key too.
    """
    columns = list(dict.fromkeys(c for keys in keysets.values() for c in keys))
    together = trips.groupingSets(list(keysets.values()), *columns).agg(
        F.grouping_id().alias("set_id"),
        *[measure.alias(name) for name, measure in _measures().items()],
    )
    return together.withColumn("feature_table", _table_name(keysets, columns)).drop("set_id")


def _table_name(keysets: Mapping[str, tuple[str, ...]], columns: list[str]) -> Column:
    def mask(keys: tuple[str, ...]) -> int:
        return reduce(lambda bits, c: bits * 2 + (c not in keys), columns, 0)

    label = F.lit(None).cast("string")
    for name, keys in keysets.items():
        label = F.when(F.col("set_id") == mask(keys), name).otherwise(label)
    return label


def table_of(together: DataFrame, name: str, keys: tuple[str, ...]) -> DataFrame:
    """One table of :func:`aggregate_together`, with its own column names."""
    measures = FEATURE_TABLES[name].measures
    return together.filter(F.col("feature_table") == name).select(
        *keys, *[F.col(source).alias(shown) for shown, source in measures.items()]
    )
