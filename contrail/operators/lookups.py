"""Lookup projections, and the facts about a lookup that decide how to join it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.casts import as_float

_ROW_OVERHEAD_BYTES = 64


def carrier_names(carriers: DataFrame) -> DataFrame:
    return carriers.select(
        F.col("iata_code").alias("airline"), F.col("airline").alias("airline_name")
    )


# Output names of an airport, after its role; only origins have a place.
_AIRPORT_NAMES = {"iata_code": "airport", "airport": "airport_name", "city": "city", "state": "state"}
_PLACE_NAMES = {"latitude": "lat", "longitude": "lon"}


def airports_as(airports: DataFrame, role: str, placed: bool) -> DataFrame:
    """The airport lookup as ``origin`` or ``destination``, with its place or without."""
    texts = [F.col(c).alias(f"{role}_{name}") for c, name in _AIRPORT_NAMES.items()]
    numbers = [as_float(c).alias(f"{role}_{name}") for c, name in _PLACE_NAMES.items()]
    return airports.select(*texts, *(numbers if placed else []))


def origin_airports(airports: DataFrame) -> DataFrame:
    return airports_as(airports, "origin", placed=True)


def destination_airports(airports: DataFrame) -> DataFrame:
    return airports_as(airports, "destination", placed=False)


@dataclass(frozen=True)
class LookupProfile:
    """Measured, not estimated: row count, size in bytes and copies of the most frequent code."""

    rows: int
    bytes: int
    max_copies: int

    @property
    def unique(self) -> bool:
        return self.max_copies <= 1

    def fits_broadcast(self, limit_bytes: int) -> bool:
        return self.bytes <= limit_bytes


def _coded_sizes(name: str, lookup: DataFrame) -> DataFrame:
    size = F.lit(_ROW_OVERHEAD_BYTES)
    for c in lookup.columns:
        size = size + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    return lookup.select(F.lit(name).alias("lookup"), "iata_code", size.cast("long").alias("size"))


def profile_lookups(lookups: Mapping[str, DataFrame]) -> dict[str, LookupProfile]:
    """One job over all lookups; what comes to the driver is one row per lookup."""
    sizes = reduce(DataFrame.unionAll, [_coded_sizes(n, df) for n, df in lookups.items()])
    # A null code never matches, so its copies cannot multiply trips.
    copies = F.when(F.col("iata_code").isNotNull(), F.col("rows"))
    measured = (
        sizes.groupBy("lookup", "iata_code")
        .agg(F.count("*").alias("rows"), F.sum("size").alias("size"))
        .groupBy("lookup")
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("size").alias("bytes"),
            F.max(copies).alias("max_copies"),
        )
    )
    found = {r["lookup"]: r for r in measured.collect()}
    return {
        name: LookupProfile(found[name]["rows"], found[name]["bytes"], found[name]["max_copies"] or 0)
        if name in found
        else LookupProfile(0, 0, 0)
        for name in lookups
    }


def duplicate_codes(lookup: DataFrame) -> DataFrame:
    """Codes that a lookup holds more than once: each multiplies the trips that carry it."""
    return (
        lookup.groupBy("iata_code").agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)
    )


def unmatched_codes(trips: DataFrame, key: str, lookup: DataFrame) -> DataFrame:
    """Trip codes that a lookup lacks, with their trip counts.

    The trips are counted per code first, so only one row per code and task is shuffled.
    """
    counts = trips.groupBy(F.col(key).alias("iata_code")).agg(F.count("*").alias("trips"))
    return counts.join(lookup.select("iata_code"), "iata_code", "left_anti")
