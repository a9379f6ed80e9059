"""Left joins of trips with the carrier and airport lookups.

A lookup is broadcast only when its measured size is within the session's broadcast threshold.
Beyond it the join is shuffled, and adaptive execution splits the partitions of hot codes (the
trip side of a left join can be split), so no code has to fit into one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators.lookups import (
    LookupProfile,
    carrier_names,
    destination_airports,
    origin_airports,
    profile_lookups,
)


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; negative when broadcasts are off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    text = text.removesuffix("b")
    if text and text[-1] in units:
        return int(text[:-1]) << units[text[-1]]
    return int(text)


@dataclass(frozen=True)
class Lookups:
    """The two lookups with their profiles."""

    carriers: DataFrame
    airports: DataFrame
    carriers_profile: LookupProfile
    airports_profile: LookupProfile

    @classmethod
    def measure(cls, carriers: DataFrame, airports: DataFrame) -> Lookups:
        found = profile_lookups({"carriers": carriers, "airports": airports})
        return cls(carriers, airports, found["carriers"], found["airports"])

    @property
    def rows(self) -> int:
        return self.carriers_profile.rows + self.airports_profile.rows

    @property
    def unique(self) -> bool:
        return self.carriers_profile.unique and self.airports_profile.unique

    def broadcast(self, spark: SparkSession) -> bool:
        """Whether both are joined without a shuffle of the trips."""
        limit = broadcast_limit(spark)
        return self.carriers_profile.fits_broadcast(limit) and self.airports_profile.fits_broadcast(limit)


def attach(trips: DataFrame, lookup: DataFrame, key: str, profile: LookupProfile) -> DataFrame:
    fits = profile.fits_broadcast(broadcast_limit(trips.sparkSession))
    side = F.broadcast(lookup) if fits else lookup.hint("merge")
    return trips.join(side, on=key, how="left")


def attach_carrier(trips: DataFrame, lookups: Lookups) -> DataFrame:
    return attach(trips, carrier_names(lookups.carriers), "airline", lookups.carriers_profile)


def attach_origin(trips: DataFrame, lookups: Lookups) -> DataFrame:
    dim = origin_airports(lookups.airports)
    return attach(trips, dim, "origin_airport", lookups.airports_profile)


def attach_destination(trips: DataFrame, lookups: Lookups) -> DataFrame:
    dim = destination_airports(lookups.airports)
    return attach(trips, dim, "destination_airport", lookups.airports_profile)


def enrich(trips: DataFrame, lookups: Lookups) -> DataFrame:
    return (
        trips.transform(attach_carrier, lookups)
        .transform(attach_origin, lookups)
        .transform(attach_destination, lookups)
    )
