"""Feature store: a database over JDBC, or a folder of Parquet tables with the same interface."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from contrail.operators.audit import observed

# The text columns of the declared tables with their greatest lengths, and the columns
# that must not be null.
TEXT_LENGTHS = {
    "airline_features": {"airline": 10, "airline_name": 100, "quarter": 5},
    "route_features": {
        "route": 10, "origin_airport": 10, "destination_airport": 10,
        "origin_city": 100, "destination_city": 100, "quarter": 5,
    },
    "airport_features": {
        "origin_airport": 10, "origin_airport_name": 200, "origin_city": 100,
        "origin_state": 50, "quarter": 5,
    },
    "hourly_features": {"quarter": 5},
}
REQUIRED = {
    "airline_features": ("airline", "quarter"),
    "route_features": ("route", "quarter"),
    "airport_features": ("origin_airport", "quarter"),
    "hourly_features": ("quarter",),
}
# The indexed columns of the declared tables, but for the quarter.
INDEXED = {
    "airline_features": ("airline",),
    "route_features": ("route", "origin_airport"),
    "airport_features": ("origin_airport",),
    "hourly_features": ("scheduled_departure_hour", "day_of_week"),
}


def check_declared(name: str, table: DataFrame) -> None:
    """An error if a text is longer than its declared column, or null where it must not be."""
    lengths, required = TEXT_LENGTHS.get(name, {}), REQUIRED.get(name, ())
    bad = {}
    for c in table.columns:
        if c in lengths:
            wrong = F.length(F.col(c).cast("string")) > lengths[c]
            bad[c] = F.count_if(wrong | F.col(c).isNull() if c in required else wrong)
    if not bad:
        return
    found = table.agg(*[n.alias(c) for c, n in bad.items()]).first().asDict()
    if any(found.values()):
        raise ValueError(f"{name}: texts that are too long for the store, or null keys: {found}")


def driver_connection(spark: SparkSession, url: str, properties: Mapping[str, str]):
    """A connection of the driver. The class of its driver is known by then: Spark has written with it."""
    java = spark._jvm.java
    own = java.util.Properties()
    for key, value in properties.items():
        own.setProperty(key, value)
    return java.sql.DriverManager.getConnection(url, own)


@dataclass(frozen=True)
class JdbcStore:
    """A table is replaced by way of a staging table: its rows are written there by all executors, and
    exchanged for the old ones in one transaction. Whatever fails before the commit leaves the old rows,
    and the declared table (its types, keys and indexes) is never dropped."""

    url: str
    properties: Mapping[str, str] = field(default_factory=dict, repr=False)
    batch_rows: int = 10_000
    connections: int = 8
    connect: Callable = driver_connection

    def replace(self, name: str, table: DataFrame) -> int:
        return self._exchange(name, table, None)

    def replace_quarter(self, name: str, table: DataFrame, quarter: str) -> int:
        """The rows of the other quarters are not touched, and not read."""
        return self._exchange(name, table.filter(F.col("quarter") == quarter), quarter)

    def _exchange(self, name: str, table: DataFrame, quarter: str | None) -> int:
        check_declared(name, table)
        staging, seen = f"{name}_staging", Observation()
        lengths = TEXT_LENGTHS.get(name, {})
        declared = ", ".join(f"{c} VARCHAR({lengths[c]})" for c in table.columns if c in lengths)
        properties = {
            **self.properties,
            "batchsize": str(self.batch_rows),
            "numPartitions": str(self.connections),
            **({"createTableColumnTypes": declared} if declared else {}),
        }
        counted = table.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.jdbc(self.url, staging, mode="overwrite", properties=properties)
        rows, columns = observed(seen).get("rows", 0), ", ".join(table.columns)
        connection = self.connect(table.sparkSession, self.url, dict(self.properties))
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            # The label is one of four; it stands in the text, for one form serves both statements.
            where = "" if quarter is None else f" WHERE quarter = '{quarter.replace(chr(39), chr(39) * 2)}'"
            statement.executeUpdate(f"DELETE FROM {name}{where}")
            moved = statement.executeUpdate(f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {staging}")
            if moved != rows:
                raise ValueError(f"{name}: {moved} rows arrived in the store, {rows} were written")
            statement.executeUpdate(f"DROP TABLE {staging}")
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()
        return rows

    def append(self, name: str, rows: DataFrame) -> None:
        rows.write.jdbc(self.url, name, mode="append", properties=dict(self.properties))

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.jdbc(self.url, name, properties=dict(self.properties))


@dataclass(frozen=True)
class FolderStore:
    """Parquet by quarter. Rows are sorted by the first of the declared indexes, and all of them have
    Bloom filters, so a lookup by key reads one row group of ``row_group_bytes`` in the best case."""

    root: str
    row_group_bytes: int = 8 << 20

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _written(self, name: str, table: DataFrame, path: str, by_quarter: bool) -> int:
        keys = [c for c in INDEXED.get(name, ()) if c in table.columns]
        quarter = ["quarter"] if by_quarter else []
        placed = table.hint("rebalance", *quarter, *keys[:1]) if quarter or keys else table
        if quarter or keys:
            placed = placed.sortWithinPartitions(*quarter, *keys)
        seen = Observation()
        writer = placed.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "static").option("parquet.block.size", self.row_group_bytes)
        for key in keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        (writer.partitionBy("quarter") if by_quarter else writer).parquet(path)
        return observed(seen).get("rows", 0)

    def replace(self, name: str, table: DataFrame) -> int:
        rows = self._written(name, table, self._path(name), True)
        if not rows:  # a file without rows keeps the schema, so the table can be read
            table.limit(0).drop("quarter").write.mode("append").parquet(f"{self._path(name)}/quarter=Q1")
        return rows

    def replace_quarter(self, name: str, table: DataFrame, quarter: str) -> int:
        """Overwrites the folder of the quarter, also when the quarter has no rows any more."""
        rows = table.filter(F.col("quarter") == quarter).drop("quarter")
        return self._written(name, rows, f"{self._path(name)}/quarter={quarter}", False)

    def append(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self._path(name))

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self._path(name))


FeatureStore = JdbcStore | FolderStore


def load_features(
    tables: Mapping[str, DataFrame], store: FeatureStore, quarter: str | None = None
) -> None:
    """Refreshes every table: as a whole, or one quarter of it."""
    for name, table in tables.items():
        load_table(name, table, store, quarter)


def load_table(name: str, table: DataFrame, store: FeatureStore, quarter: str | None = None) -> int:
    """The rows that arrived, as the store's write counts them."""
    if quarter is None:
        return store.replace(name, table)
    return store.replace_quarter(name, table, quarter)


def lookup_features(
    spark: SparkSession, store: FeatureStore, name: str, quarter: str | None = None, **keys: object
) -> DataFrame:
    """Serving read. Equality filters on stored columns, so the store evaluates them."""
    found = store.read(spark, name)
    if quarter is not None:
        found = found.filter(F.col("quarter") == quarter)
    for key, value in keys.items():
        found = found.filter(F.col(key) == F.lit(value))
    return found
