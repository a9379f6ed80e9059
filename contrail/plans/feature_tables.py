"""Feature tables from trips and lookups, with the joins placed by what the lookups allow.

With unique lookup codes the names depend on the codes, so trips are grouped by code and the names
join the few resulting groups: no join touches the trips. A repeated code multiplies trips, which
every count must show; then the trips are joined first.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.trips import route_key
from contrail.operators.aggregates import (
    FEATURE_TABLES,
    aggregate_table,
    aggregate_together,
    stamped,
    table_of,
)
from contrail.operators.enrich import (
    Lookups,
    attach_carrier,
    attach_destination,
    attach_origin,
    enrich,
)
from contrail.scratch import materialise

_NAMES = {
    "airline_features": (attach_carrier,),
    "route_features": (attach_origin, attach_destination),
    "airport_features": (attach_origin,),
    "hourly_features": (),
}


def _enriched(trips: DataFrame, lookups: Lookups) -> DataFrame:
    return trips if "airline_name" in trips.columns else enrich(trips, lookups)


def _named(groups: DataFrame, name: str, lookups: Lookups) -> DataFrame:
    for attach in _NAMES[name]:
        groups = groups.transform(attach, lookups)
    table = FEATURE_TABLES[name]
    if "route" in table.keys:
        groups = groups.withColumn("route", route_key())
    return groups.select(*table.keys, *table.measures)


def feature_table(trips: DataFrame, lookups: Lookups, name: str) -> DataFrame:
    """One table as a lazy plan. ``trips`` are clean, with or without lookup columns; the hourly
    table needs their departure hour."""
    if not lookups.unique:
        return aggregate_table(_enriched(trips, lookups), name)
    return _named(aggregate_table(trips, name, FEATURE_TABLES[name].codes), name, lookups)


@dataclass(frozen=True)
class FeatureGroups:
    """The rows of all four tables, written once, with the keys that each is grouped by."""

    rows: DataFrame
    keysets: Mapping[str, tuple[str, ...]]
    lookups: Lookups

    def tables(self, processed_at: datetime | None = None) -> dict[str, DataFrame]:
        return {name: self._table(name, processed_at) for name in self.keysets}

    def _table(self, name: str, processed_at: datetime | None) -> DataFrame:
        table = table_of(self.rows, name, self.keysets[name])
        if self.lookups.unique:
            table = _named(table, name, self.lookups)
        return table if processed_at is None else stamped(table, processed_at)

    def sizes(self) -> tuple[dict[str, int], int]:
        """Rows of each table that has any, and the trips that were grouped, in one small job."""
        found = self.rows.groupBy("feature_table").agg(F.count("*").alias("rows"), F.sum("trips").alias("trips"))
        by_table = {r["feature_table"]: r for r in found.collect()}
        first = by_table.get(next(iter(self.keysets)))
        return {name: r["rows"] for name, r in by_table.items()}, first["trips"] if first else 0


def feature_groups(trips: DataFrame, lookups: Lookups) -> FeatureGroups:
    """All four tables from one scan of clean trips with their departure hour."""
    if lookups.unique:
        keysets = {name: table.codes for name, table in FEATURE_TABLES.items()}
        source = trips
    else:
        keysets = {name: table.keys for name, table in FEATURE_TABLES.items()}
        source = _enriched(trips, lookups)
    together = aggregate_together(source, keysets)
    rows = materialise(together, "feature_groups", partition_by="feature_table")
    return FeatureGroups(rows, keysets, lookups)
