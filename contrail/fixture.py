"""Projects the TPC-H-like test tables to trips, carriers and airports.

The SQL runs unchanged in Spark and in DuckDB, so tests compare both engines on the same rows. The
joins carry no hints: their sides grow with the data, and the planner chooses by size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_nationkey int",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey long, o_custkey long",
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz"
    ),
}

TRIPS = """
SELECT cast(year(l_shipdate) AS int) AS year, cast(month(l_shipdate) AS int) AS month,
       cast(day(l_shipdate) AS int) AS day, cast(l_orderkey % 7 + 1 AS int) AS day_of_week,
       cast(l_suppkey AS string) AS airline, cast(l_partkey AS string) AS flight_number,
       cast(c_nationkey AS string) AS origin_airport,
       cast(s_nationkey AS string) AS destination_airport,
       lpad(cast((l_orderkey % 24) * 100 + l_partkey % 60 AS string), 4, '0') AS scheduled_departure,
       CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN NULL ELSE '1200' END AS departure_time,
       CASE WHEN l_returnflag = 'N' AND l_linenumber = 5 THEN NULL
            ELSE cast(l_quantity - 25 AS float) END AS departure_delay,
       CASE WHEN l_returnflag = 'A' AND l_linenumber = 6 THEN NULL
            ELSE cast(l_quantity - 20 AS float) END AS arrival_delay,
       cast(l_linenumber * 3 AS float) AS taxi_out, cast(l_linenumber * 2 AS float) AS taxi_in,
       cast(l_quantity * 7 AS float) AS air_time, cast(l_quantity * 8 AS float) AS elapsed_time,
       cast(l_quantity * 8 - 5 AS float) AS scheduled_time,
       cast(l_extendedprice AS float) AS distance, '0' AS diverted,
       CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN '1' ELSE '0' END AS cancelled,
       CASE WHEN l_quantity > 35 AND l_linenumber <= 3
            THEN cast(l_linenumber * 4 AS float) END AS weather_delay,
       CASE WHEN l_quantity > 35 AND l_linenumber <= 5
            THEN cast(l_linenumber AS float) END AS airline_delay,
       CASE WHEN l_quantity > 35 THEN cast(l_linenumber - 3 AS float) END AS air_system_delay,
       CASE WHEN l_quantity > 35 AND l_linenumber = 2 THEN cast(9 AS float) END AS late_aircraft_delay,
       CASE WHEN l_quantity > 48 THEN cast(1 AS float) END AS security_delay
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
     JOIN supplier ON l_suppkey = s_suppkey
"""

CARRIERS = """
SELECT cast(s_suppkey AS string) AS iata_code, s_name AS airline
FROM supplier WHERE s_suppkey % 10 <> 3
"""

AIRPORTS = """
SELECT cast(n_nationkey AS string) AS iata_code, n_name AS airport,
       concat(n_name, '_CITY') AS city, r_name AS state,
       cast(n_nationkey * 1.5 AS float) AS latitude, cast(n_nationkey * -2.5 AS float) AS longitude
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 7
"""


def _whole(name: str) -> str:
    return f"cast(cast(floor({name}) AS int) AS string)"


# The trip file as it would arrive: 31 text columns in upper case, with unreadable taxi times, days
# written as decimals, blank tail numbers and non-zero flags among them.
RAW_TRIPS = f"""
SELECT cast(year AS string) AS YEAR, cast(month AS string) AS MONTH,
       CASE WHEN day % 9 = 4 THEN concat(cast(day AS string), '.0')
            ELSE cast(day AS string) END AS DAY,
       cast(day_of_week AS string) AS DAY_OF_WEEK,
       airline AS AIRLINE, flight_number AS FLIGHT_NUMBER,
       CASE WHEN day_of_week = 3 THEN NULL ELSE concat('N', airline) END AS TAIL_NUMBER,
       origin_airport AS ORIGIN_AIRPORT, destination_airport AS DESTINATION_AIRPORT,
       scheduled_departure AS SCHEDULED_DEPARTURE, departure_time AS DEPARTURE_TIME,
       {_whole("departure_delay")} AS DEPARTURE_DELAY,
       CASE WHEN day = 13 THEN 'n/a' ELSE {_whole("taxi_out")} END AS TAXI_OUT,
       cast(NULL AS string) AS WHEELS_OFF, {_whole("scheduled_time")} AS SCHEDULED_TIME,
       {_whole("elapsed_time")} AS ELAPSED_TIME, {_whole("air_time")} AS AIR_TIME,
       {_whole("distance")} AS DISTANCE, cast(NULL AS string) AS WHEELS_ON,
       {_whole("taxi_in")} AS TAXI_IN, cast(NULL AS string) AS SCHEDULED_ARRIVAL,
       cast(NULL AS string) AS ARRIVAL_TIME, {_whole("arrival_delay")} AS ARRIVAL_DELAY,
       diverted AS DIVERTED, cancelled AS CANCELLED,
       CASE WHEN cancelled = '1' THEN 'B' END AS CANCELLATION_REASON,
       {_whole("air_system_delay")} AS AIR_SYSTEM_DELAY, {_whole("security_delay")} AS SECURITY_DELAY,
       {_whole("airline_delay")} AS AIRLINE_DELAY,
       {_whole("late_aircraft_delay")} AS LATE_AIRCRAFT_DELAY,
       {_whole("weather_delay")} AS WEATHER_DELAY
FROM ({TRIPS}) AS trips
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table, with the columns that the fixture uses and no schema inference job."""
    return spark.read.schema(_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


# Joined among themselves first, the narrow tables spare lineitem a second shuffle when no side is small.
_JOINS = "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"
_NARROW_FIRST = (
    "FROM lineitem JOIN (SELECT o_orderkey, c_nationkey "
    "FROM orders JOIN customer ON o_custkey = c_custkey) ON l_orderkey = o_orderkey"
)


def _query(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    sql = sql.replace(_JOINS, _NARROW_FIRST)
    for name in names:
        sql = sql.replace(f"FROM {name} ", f"FROM {{{name}}} ")
        sql = sql.replace(f"JOIN {name} ", f"JOIN {{{name}}} ")
    return spark.sql(sql, **{name: table(spark, sf_dir, name) for name in names})


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _query(spark, sf_dir, TRIPS, "lineitem", "orders", "customer", "supplier")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _query(spark, sf_dir, RAW_TRIPS, "lineitem", "orders", "customer", "supplier")


def carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _query(spark, sf_dir, CARRIERS, "supplier")


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _query(spark, sf_dir, AIRPORTS, "nation", "region")
