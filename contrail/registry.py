"""Every operator as a query over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail import fixture
from contrail.functions.trips import in_quarter
from contrail.operators import clean as cleaning
from contrail.operators import features, lookups, messages
from contrail.operators.aggregates import FEATURE_TABLES, aggregate_together
from contrail.operators.audit import counted
from contrail.operators.enrich import (
    Lookups,
    attach_carrier,
    attach_destination,
    attach_origin,
    enrich,
)
from contrail.plans.batch import RUN_LOG, rows_seen, run
from contrail.plans.feature_tables import feature_groups, feature_table
from contrail.schemas import CALENDAR_COLUMNS, IDENTITY_COLUMNS, MEASURE_COLUMNS, MESSAGE_TOPIC
from contrail.schemas import TRIP_COLUMNS
from contrail.scratch import new_path, shuffles_removed
from contrail.sinks.lake import write_processed
from contrail.sinks.store import FolderStore, load_features, lookup_features
from contrail.sinks.topic import publish
from contrail.sources.files import read_lookup, read_trips
from contrail.sources.lake import read_processed, read_raw
from contrail.streaming.landing import land, read_topic
from contrail.streaming.publishing import publish_files, read_trip_files

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

INGESTED_AT = "2015-01-01T00:00:00"
TRIP_ID = ("airline", "flight_number", "year", "month", "day", "scheduled_departure")
ID = ", ".join(TRIP_ID)


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name or fn.__name__] = fn
        if sql is not None:
            ORACLES[name or fn.__name__] = sql
        return fn

    return register


# Shared SQL -------------------------------------------------------------------------------------

_QUARTER = (
    "CASE WHEN month IN (1, 2, 3) THEN 'Q1' WHEN month IN (4, 5, 6) THEN 'Q2' "
    "WHEN month IN (7, 8, 9) THEN 'Q3' ELSE 'Q4' END"
)
_HOUR = "cast(trunc(cast(scheduled_departure AS int) / 100) AS int)"
_OPERATED = "cancelled = '0' AND arrival_delay IS NOT NULL AND departure_delay IS NOT NULL"

_TRIPS = f"trips AS ({fixture.TRIPS})"
_RAW = f"raw AS ({fixture.RAW_TRIPS})"
_CARRIERS = f"carriers AS ({fixture.CARRIERS})"
_AIRPORTS = f"airports AS ({fixture.AIRPORTS})"


def _cleaned(source: str = "trips") -> str:
    return (
        f"cleaned AS (SELECT *, cast(arrival_delay > 15 AS int) AS is_delayed, "
        f"{_QUARTER} AS quarter, origin_airport || '-' || destination_airport AS route, "
        f"{_HOUR} AS scheduled_departure_hour FROM {source} WHERE {_OPERATED})"
    )


_ENRICHED = (
    "enriched AS (SELECT t.*, c.airline AS airline_name, "
    "o.airport AS origin_airport_name, o.city AS origin_city, o.state AS origin_state, "
    "o.latitude AS origin_lat, o.longitude AS origin_lon, "
    "d.airport AS destination_airport_name, d.city AS destination_city, "
    "d.state AS destination_state FROM cleaned t "
    "LEFT JOIN carriers c ON t.airline = c.iata_code "
    "LEFT JOIN airports o ON t.origin_airport = o.iata_code "
    "LEFT JOIN airports d ON t.destination_airport = d.iata_code)"
)
# The trip file read as numbers: the typed form of the raw fixture.
_PARSED = (
    "parsed AS (SELECT "
    + ", ".join(
        f"try_cast(try_cast({c} AS double) AS int) AS {c}"
        if c in CALENDAR_COLUMNS
        else f"try_cast({c} AS float) AS {c}"
        if c in MEASURE_COLUMNS
        else f"{c} AS {c}"
        for c in TRIP_COLUMNS
    )
    + " FROM raw)"
)


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


_CLEAN = _with(_TRIPS, _cleaned())
_ALL = _with(_TRIPS, _CARRIERS, _AIRPORTS, _cleaned(), _ENRICHED)
_ALL_RAW = _with(_RAW, _PARSED, _CARRIERS, _AIRPORTS, _cleaned("parsed"), _ENRICHED)


def _round(x: str) -> str:
    """Half up on the printed decimal, as Spark rounds doubles."""
    return f"cast(round(cast(cast({x} AS varchar) AS decimal(38, 18)), 2) AS double)"


_MEASURE_SQL = {
    "trips": "count(*)",
    "delayed": "cast(sum(is_delayed) AS bigint)",
    "delay_rate": _round("cast(sum(is_delayed) AS double) / count(*) * 100"),
    "mean_arrival_delay": _round("avg(arrival_delay)"),
    "std_arrival_delay": _round("stddev_samp(arrival_delay)"),
    "mean_departure_delay": _round("avg(departure_delay)"),
    "mean_weather_delay": _round("avg(weather_delay)"),
    "mean_airline_delay": _round("avg(airline_delay)"),
    "mean_system_delay": _round("avg(air_system_delay)"),
    "mean_distance": _round("avg(distance)"),
    "mean_air_time": _round("avg(air_time)"),
    "mean_taxi_out": _round("avg(taxi_out)"),
}


# Written out, not taken from the code under test: keys, and each column with what it holds.
_TABLE_SQL = {
    "airline_features": (
        "airline, airline_name, quarter",
        "count(*) AS total_flights, cast(sum(is_delayed) AS bigint) AS delayed_flights, "
        f"{_round('avg(arrival_delay)')} AS avg_arrival_delay_min, "
        f"{_round('avg(departure_delay)')} AS avg_departure_delay_min, "
        f"{_round('stddev_samp(arrival_delay)')} AS std_arrival_delay, "
        f"{_round('cast(sum(is_delayed) AS double) / count(*) * 100')} AS delay_rate_pct, "
        f"{_round('avg(weather_delay)')} AS avg_weather_delay_min, "
        f"{_round('avg(airline_delay)')} AS avg_carrier_delay_min, "
        f"{_round('avg(air_system_delay)')} AS avg_nas_delay_min",
    ),
    "route_features": (
        "route, origin_airport, destination_airport, origin_city, destination_city, quarter",
        "count(*) AS total_flights, cast(sum(is_delayed) AS bigint) AS delayed_flights, "
        f"{_round('avg(arrival_delay)')} AS avg_arrival_delay_min, "
        f"{_round('avg(departure_delay)')} AS avg_departure_delay_min, "
        f"{_round('cast(sum(is_delayed) AS double) / count(*) * 100')} AS delay_rate_pct, "
        f"{_round('avg(distance)')} AS avg_distance_miles, "
        f"{_round('avg(air_time)')} AS avg_air_time_min",
    ),
    "airport_features": (
        "origin_airport, origin_airport_name, origin_city, origin_state, quarter",
        "count(*) AS total_departures, cast(sum(is_delayed) AS bigint) AS delayed_departures, "
        f"{_round('avg(departure_delay)')} AS avg_departure_delay_min, "
        f"{_round('cast(sum(is_delayed) AS double) / count(*) * 100')} AS departure_delay_rate_pct, "
        f"{_round('avg(taxi_out)')} AS avg_taxi_out_min",
    ),
    "hourly_features": (
        "scheduled_departure_hour, day_of_week, quarter",
        "count(*) AS total_flights, cast(sum(is_delayed) AS bigint) AS delayed_flights, "
        f"{_round('avg(arrival_delay)')} AS avg_arrival_delay_min, "
        f"{_round('cast(sum(is_delayed) AS double) / count(*) * 100')} AS delay_rate_pct",
    ),
}


def _table_sql(name: str, source: str = "enriched") -> str:
    keys, shown = _TABLE_SQL[name]
    return f"SELECT {keys}, {shown} FROM {source} GROUP BY {keys}"


# Inputs -----------------------------------------------------------------------------------------


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.trips(spark, sf_dir).transform(cleaning.clean)


def _lookups(spark: SparkSession, sf_dir: str) -> Lookups:
    return Lookups.measure(fixture.carriers(spark, sf_dir), fixture.airports(spark, sf_dir))


def _grouped_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir).transform(features.add_departure_hour)


def _csv(df: DataFrame, label: str) -> str:
    path = new_path(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        df.write.option("header", True).option("compression", "gzip").csv(path)
    return path


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.to_messages(fixture.raw_trips(spark, sf_dir), INGESTED_AT)


# Sources ----------------------------------------------------------------------------------------


@query(fixture.RAW_TRIPS)
def csv_scan_all_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_trips(spark, _csv(fixture.raw_trips(spark, sf_dir), "trips_csv"))


@query(_with(_CARRIERS) + "SELECT iata_code, airline FROM carriers")
def csv_lookup_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_lookup(spark, _csv(fixture.carriers(spark, sf_dir), "carriers_csv"))


@query(
    _with(_AIRPORTS) + "SELECT iata_code, airport, city, state, "
    "cast(latitude AS varchar) AS latitude, cast(longitude AS varchar) AS longitude FROM airports"
)
def csv_lookup_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_lookup(spark, _csv(fixture.airports(spark, sf_dir), "airports_csv"))


# Cleaning ---------------------------------------------------------------------------------------


@query(_with(_RAW) + "SELECT " + ", ".join(f"{c} AS {c}" for c in TRIP_COLUMNS) + " FROM raw")
def rename_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.raw_trips(spark, sf_dir).transform(cleaning.lower_names)


@query(
    _with(_RAW, _PARSED) + "SELECT airline, flight_number, scheduled_departure, "
    + ", ".join(MEASURE_COLUMNS) + " FROM parsed"
)
def cast_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = rename_lower(spark, sf_dir).transform(cleaning.cast_measures)
    return df.select("airline", "flight_number", "scheduled_departure", *MEASURE_COLUMNS)


@query(_with(_RAW, _PARSED) + "SELECT airline, flight_number, year, month, day, day_of_week FROM parsed")
def cast_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = rename_lower(spark, sf_dir).transform(cleaning.cast_calendar)
    return df.select("airline", "flight_number", *CALENDAR_COLUMNS)


@query(_with(_TRIPS) + f"SELECT {ID}, cancelled FROM trips WHERE cancelled = '0'")
def filter_not_cancelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixture.trips(spark, sf_dir).transform(cleaning.keep_operated)
    return df.select(*TRIP_ID, "cancelled")


@query(
    _with(_TRIPS) + f"SELECT {ID}, arrival_delay, departure_delay FROM trips "
    "WHERE arrival_delay IS NOT NULL AND departure_delay IS NOT NULL"
)
def drop_missing_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixture.trips(spark, sf_dir).transform(cleaning.keep_measured)
    return df.select(*TRIP_ID, "arrival_delay", "departure_delay")


@query(_CLEAN + f"SELECT {ID}, arrival_delay, is_delayed FROM cleaned")
def flag_delayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir).select(*TRIP_ID, "arrival_delay", "is_delayed")


@query(_CLEAN + f"SELECT {ID}, quarter FROM cleaned")
def quarter_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir).select(*TRIP_ID, "quarter")


@query(_CLEAN + f"SELECT {ID}, origin_airport, destination_airport, route FROM cleaned")
def route_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir).select(*TRIP_ID, "origin_airport", "destination_airport", "route")


@query(_CLEAN + f"SELECT {ID}, quarter, arrival_delay FROM cleaned WHERE quarter = 'Q2'")
def quarter_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _clean(spark, sf_dir).transform(cleaning.select_quarter, "Q2")
    return df.select(*TRIP_ID, "quarter", "arrival_delay")


@query(_ALL_RAW + f"SELECT {ID}, quarter, route, is_delayed, arrival_delay, distance FROM cleaned")
def clean_raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixture.raw_trips(spark, sf_dir).transform(cleaning.clean)
    return df.select(*TRIP_ID, "quarter", "route", "is_delayed", "arrival_delay", "distance")


# Lookups and joins ------------------------------------------------------------------------------


@query(_with(_CARRIERS) + "SELECT iata_code AS airline, airline AS airline_name FROM carriers")
def dim_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.carrier_names(fixture.carriers(spark, sf_dir))


@query(
    _with(_AIRPORTS) + "SELECT iata_code AS origin_airport, airport AS origin_airport_name, "
    "city AS origin_city, state AS origin_state, latitude AS origin_lat, "
    "longitude AS origin_lon FROM airports"
)
def dim_airports_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.origin_airports(fixture.airports(spark, sf_dir))


@query(
    _with(_AIRPORTS) + "SELECT iata_code AS destination_airport, "
    "airport AS destination_airport_name, city AS destination_city, "
    "state AS destination_state FROM airports"
)
def dim_airports_destination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.destination_airports(fixture.airports(spark, sf_dir))


@query(_ALL + f"SELECT {ID}, airline_name FROM enriched")
def join_carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _clean(spark, sf_dir).transform(attach_carrier, _lookups(spark, sf_dir))
    return df.select(*TRIP_ID, "airline_name")


_ORIGIN = (
    "origin_airport", "origin_airport_name", "origin_city", "origin_state", "origin_lat", "origin_lon",
)
_DESTINATION = (
    "destination_airport", "destination_airport_name", "destination_city", "destination_state",
)


@query(_ALL + f"SELECT {ID}, {', '.join(_ORIGIN)} FROM enriched")
def join_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _clean(spark, sf_dir).transform(attach_origin, _lookups(spark, sf_dir))
    return df.select(*TRIP_ID, *_ORIGIN)


@query(_ALL + f"SELECT {ID}, {', '.join(_DESTINATION)} FROM enriched")
def join_destination(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _clean(spark, sf_dir).transform(attach_destination, _lookups(spark, sf_dir))
    return df.select(*TRIP_ID, *_DESTINATION)


@query(
    _with(_TRIPS, _CARRIERS) + "SELECT airline AS iata_code, count(*) AS trips FROM trips "
    "WHERE airline NOT IN (SELECT iata_code FROM carriers) GROUP BY airline"
)
def lookup_unmatched_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = fixture.trips(spark, sf_dir)
    return lookups.unmatched_codes(trips, "airline", fixture.carriers(spark, sf_dir))


@query(
    "SELECT cast(s_nationkey AS varchar) AS iata_code, count(*) AS copies FROM supplier "
    "GROUP BY s_nationkey HAVING count(*) > 1"
)
def lookup_duplicate_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_nation = fixture.table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").cast("string").alias("iata_code")
    )
    return lookups.duplicate_codes(by_nation)


# Row-level features -----------------------------------------------------------------------------

_MINUTES = {c: f"coalesce({c}, cast(0 AS float))" for c in MEASURE_COLUMNS}
_FLAGS_SQL = (
    f"cast({_MINUTES['weather_delay']} > 0 AS int) AS has_weather_delay, "
    f"cast({_MINUTES['airline_delay']} > 0 AS int) AS has_carrier_delay, "
    f"cast({_MINUTES['air_system_delay']} > 0 AS int) AS has_nas_delay, "
    f"cast({_MINUTES['late_aircraft_delay']} > 0 AS int) AS has_late_aircraft_delay"
)
_TOTAL_SQL = (
    f"{_MINUTES['weather_delay']} + {_MINUTES['airline_delay']} + {_MINUTES['air_system_delay']} + "
    f"{_MINUTES['late_aircraft_delay']} + {_MINUTES['security_delay']} AS total_delay_causes_min"
)


@query(_CLEAN + f"SELECT {ID}, scheduled_departure_hour FROM cleaned")
def hour_from_hhmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grouped_input(spark, sf_dir).select(*TRIP_ID, "scheduled_departure_hour")


@query(_CLEAN + f"SELECT {ID}, {_FLAGS_SQL} FROM cleaned")
def cause_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _clean(spark, sf_dir).transform(features.engineer_features)
    return df.select(*TRIP_ID, *features.CAUSE_FLAGS)


@query(_CLEAN + f"SELECT {ID}, {_TOTAL_SQL} FROM cleaned")
def cause_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _clean(spark, sf_dir).transform(features.engineer_features)
    return df.select(*TRIP_ID, "total_delay_causes_min")


@query(
    _ALL + "SELECT airline, departure_delay, is_delayed, scheduled_departure_hour, "
    f"cast({_MINUTES['weather_delay']} > 0 AS int) AS has_weather_delay, {_TOTAL_SQL} FROM enriched"
)
def feature_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _clean(spark, sf_dir).transform(enrich, _lookups(spark, sf_dir))
    return df.transform(features.engineer_features).transform(features.preview)


# Feature tables ---------------------------------------------------------------------------------


def _feature_query(name: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return feature_table(_grouped_input(spark, sf_dir), _lookups(spark, sf_dir), name)

    return build


for _name in FEATURE_TABLES:
    query(_ALL + _table_sql(_name), name=_name)(_feature_query(_name))


# What each table is grouped by, and the codes as the four SELECT lists show them.
_TOGETHER = {
    "airline_features": (
        "airline, quarter",
        "airline, quarter, NULL AS origin_airport, NULL AS destination_airport, "
        "NULL AS scheduled_departure_hour, NULL AS day_of_week",
    ),
    "route_features": (
        "origin_airport, destination_airport, quarter",
        "NULL AS airline, quarter, origin_airport, destination_airport, "
        "NULL AS scheduled_departure_hour, NULL AS day_of_week",
    ),
    "airport_features": (
        "origin_airport, quarter",
        "NULL AS airline, quarter, origin_airport, NULL AS destination_airport, "
        "NULL AS scheduled_departure_hour, NULL AS day_of_week",
    ),
    "hourly_features": (
        "scheduled_departure_hour, day_of_week, quarter",
        "NULL AS airline, quarter, NULL AS origin_airport, NULL AS destination_airport, "
        "scheduled_departure_hour, day_of_week",
    ),
}
_TOGETHER_MEASURES = ", ".join(f"{sql} AS {m}" for m, sql in _MEASURE_SQL.items())


@query(
    _CLEAN
    + " UNION ALL ".join(
        f"SELECT '{name}' AS feature_table, {shown}, {_TOGETHER_MEASURES} FROM cleaned GROUP BY {keys}"
        for name, (keys, shown) in _TOGETHER.items()
    )
)
def feature_tables_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-pass plan behind the run: all four tables from one scan and one shuffle."""
    keysets = {name: table.codes for name, table in FEATURE_TABLES.items()}
    return aggregate_together(_grouped_input(spark, sf_dir), keysets)


_RENAMED = (
    "SELECT cast(s_suppkey AS string) AS iata_code, concat(s_name, '_OLD') AS airline "
    "FROM supplier WHERE s_acctbal < 5000"
)


@query(
    _with(
        _TRIPS, f"carriers AS ({fixture.CARRIERS} UNION ALL {_RENAMED})", _AIRPORTS, _cleaned(), _ENRICHED
    )
    + _table_sql("airline_features")
)
def airline_features_repeated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup that lists codes twice: each copy counts, as in a plain left join."""
    supplier = fixture.table(spark, sf_dir, "supplier")
    renamed = spark.sql(_RENAMED.replace("FROM supplier", "FROM {supplier}"), supplier=supplier)
    carriers = fixture.carriers(spark, sf_dir).unionAll(renamed)
    found = Lookups.measure(carriers, fixture.airports(spark, sf_dir))
    return feature_table(_grouped_input(spark, sf_dir), found, "airline_features")


# Messages ---------------------------------------------------------------------------------------

_PUBLISHABLE = "coalesce(FLIGHT_NUMBER, '') <> '' AND coalesce(DEPARTURE_TIME, '') <> ''"
_KEY_SQL = (
    "coalesce(AIRLINE, '') || '-' || coalesce(FLIGHT_NUMBER, '') || '-' || coalesce(YEAR, '') "
    "|| coalesce(MONTH, '') || coalesce(DAY, '')"
)
_VALUE_SQL = (
    "cast(json_object("
    + ", ".join(f"'{c}', coalesce({c}, '')" for c in TRIP_COLUMNS)
    + f", 'ingested_at', '{INGESTED_AT}') AS varchar)"
)


@query(
    _with(_RAW) + "SELECT airline AS airline, flight_number AS flight_number, "
    f"departure_time AS departure_time FROM raw WHERE {_PUBLISHABLE}"
)
def publish_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = rename_lower(spark, sf_dir).transform(messages.keep_publishable)
    return df.select("airline", "flight_number", "departure_time")


@query(_with(_RAW) + f"SELECT {_KEY_SQL} AS key FROM raw WHERE {_PUBLISHABLE}")
def message_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(spark, sf_dir).select("key")


@query(_with(_RAW) + f"SELECT {_VALUE_SQL} AS value FROM raw WHERE {_PUBLISHABLE}")
def message_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(spark, sf_dir).select("value")


@query(
    _with(_RAW) + f"SELECT count(*) AS total_rows, count(*) FILTER ({_PUBLISHABLE}) AS published, "
    f"count(*) FILTER (NOT ({_PUBLISHABLE})) AS skipped FROM raw"
)
def publish_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.publish_stats(fixture.raw_trips(spark, sf_dir))


@query(_with(_RAW) + f"SELECT {_KEY_SQL} AS key, {_VALUE_SQL} AS value FROM raw WHERE {_PUBLISHABLE}")
def publish_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = new_path(spark, "topic")
    publish(_messages(spark, sf_dir), "parquet", {"path": topic})
    return spark.read.schema(MESSAGE_TOPIC).parquet(topic)


def _second_half() -> Column:
    """By columns that come straight from the fact table, so the filter runs before the joins and does
    not make the text of a trip twice. Null columns are hashed like others."""
    return F.pmod(F.xxhash64("AIRLINE", "FLIGHT_NUMBER", "DAY_OF_WEEK"), F.lit(2)) == 1


@query(_with(_RAW) + f"SELECT {_KEY_SQL} AS key, {_VALUE_SQL} AS value FROM raw WHERE {_PUBLISHABLE}")
def publish_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File by file, in three runs over one ledger: half of the files, the others, and nothing new."""
    folder, topic, ledger = (new_path(spark, label) for label in ("trips", "topic", "ledger"))
    trips = fixture.raw_trips(spark, sf_dir)
    second = _second_half()
    for part in (trips.filter(~second), trips.filter(second), trips.limit(0)):
        with shuffles_removed(spark):
            part.write.mode("append").option("header", True).csv(folder)
        files = read_trip_files(spark, folder, 2)
        publish_files(files, "parquet", {"path": topic}, ledger, ingested_at=INGESTED_AT).awaitTermination()
    return spark.read.schema(MESSAGE_TOPIC).parquet(topic)


# Landing and lake -------------------------------------------------------------------------------

_LANDED = (
    "landed AS (SELECT "
    + ", ".join(
        f"try_cast(try_cast({c} AS double) AS int) AS {c}" if c in ("year", "month") else f"{c} AS {c}"
        for c in TRIP_COLUMNS
    )
    + f", '{INGESTED_AT}' AS ingested_at, cast(NULL AS varchar) AS corrupt_value, "
    f"{_KEY_SQL} AS message_key FROM raw WHERE {_PUBLISHABLE})"
)


def _land_twice(spark: SparkSession, topic: str, **options) -> str:
    """Lands, then runs again: the second run must find nothing new."""
    root, checkpoint = new_path(spark, "raw"), new_path(spark, "landing")
    for _ in range(2):
        stream = read_topic(spark, "parquet", {"path": topic})
        land(stream, root, checkpoint, **options).awaitTermination()
    return root


@query(_with(_RAW, _LANDED) + "SELECT * FROM landed")
def stream_land_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = new_path(spark, "topic")
    publish(_messages(spark, sf_dir), "parquet", {"path": topic})
    return read_raw(spark, _land_twice(spark, topic))


# Of the rows of a trip that arrive together the least stays, by its columns as they are landed.
_LANDED_ORDER = [c for c in TRIP_COLUMNS if c not in ("year", "month")]
_ONE_PER_TRIP = (
    "one_per_trip AS (SELECT * FROM landed QUALIFY row_number() OVER (PARTITION BY "
    + ", ".join((*IDENTITY_COLUMNS, "message_key"))
    + " ORDER BY "
    + ", ".join(f"{c} NULLS FIRST" for c in _LANDED_ORDER)
    + ") = 1)"
)


def _twice_together(sent: DataFrame) -> DataFrame:
    """Every message twice. Equal keys share a file, as they share a topic partition, so all messages of
    a trip arrive together; a task writes one file."""
    return sent.repartition("key").withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))


@query(_with(_RAW, _LANDED, _ONE_PER_TRIP) + "SELECT * FROM one_per_trip")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message is sent three times, twice in one batch and once for a later run, which reads the
    topic from its beginning again. Each trip comes out once, whole."""
    topic, index = new_path(spark, "topic"), new_path(spark, "seen")
    root = new_path(spark, "raw")
    sent = _messages(spark, sf_dir)
    publish(_twice_together(sent), "parquet", {"path": topic})
    for later in (sent, sent.limit(0)):
        stream = read_topic(spark, "parquet", {"path": topic})
        land(stream, root, new_path(spark, "landing"), index).awaitTermination()
        publish(later, "parquet", {"path": topic})
    return read_raw(spark, root)


@query(_with(_RAW, _LANDED) + "SELECT * FROM landed")
def stream_land_sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months get as many files as their size calls for; no message is lost on the way."""
    topic = new_path(spark, "topic")
    publish(_messages(spark, sf_dir), "parquet", {"path": topic})
    return read_raw(spark, _land_twice(spark, topic, file_bytes=4_000_000))


@query(
    _with(_RAW, _LANDED) + "SELECT message_key, year, month, day, airline, arrival_delay "
    "FROM landed WHERE year = 1996 AND month IN (1, 2, 3)"
)
def lake_partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "raw")
    rows = messages.from_messages(_messages(spark, sf_dir))
    rows.write.partitionBy("year", "month").parquet(root)
    df = read_raw(spark, root, year=1996, months=(1, 2, 3))
    return df.select("message_key", "year", "month", "day", "airline", "arrival_delay")


@query(
    _ALL + f"SELECT {ID}, quarter, airline_name, origin_city, destination_city, is_delayed, "
    f"{_TOTAL_SQL} FROM enriched WHERE quarter <> 'Q1' OR day <= 10"
)
def lake_processed_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all quarters, then the first one again with fewer rows: only that one changes."""
    df = _clean(spark, sf_dir).transform(enrich, _lookups(spark, sf_dir))
    df = df.transform(features.engineer_features)
    root = new_path(spark, "processed")
    write_processed(df, root)
    write_processed(df.filter(in_quarter("Q1") & (F.col("day") <= 10)), root)
    return read_processed(spark, root).select(
        *TRIP_ID, "quarter", "airline_name", "origin_city", "destination_city", "is_delayed",
        "total_delay_causes_min",
    )


# Store, log and counts --------------------------------------------------------------------------


def _run_all(
    spark: SparkSession, sf_dir: str, quarter: str | None = None, lake: bool = True
) -> FolderStore:
    store = FolderStore(new_path(spark, "store"))
    run(
        spark,
        csv_scan_all_string(spark, sf_dir),
        csv_lookup_carriers(spark, sf_dir),
        csv_lookup_airports(spark, sf_dir),
        store,
        new_path(spark, "processed") if lake else None,
        quarter,
    )
    return store


@query(_ALL_RAW + _table_sql("airline_features"))
def run_store_carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run from the CSV files, then the carrier table as the store holds it."""
    return _run_all(spark, sf_dir).read(spark, "airline_features").drop("processed_at")


@query(_ALL_RAW + _table_sql("route_features") + " HAVING quarter = 'Q3'")
def run_store_route_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run for one quarter."""
    return _run_all(spark, sf_dir, "Q3").read(spark, "route_features").drop("processed_at")


@query(_ALL_RAW + _table_sql("airport_features"))
def run_store_airport_tables_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run without a processed lake: tables straight from the CSV file."""
    store = _run_all(spark, sf_dir, lake=False)
    return store.read(spark, "airport_features").drop("processed_at")


def _without_first_quarter(spark: SparkSession, sf_dir: str) -> tuple[FolderStore, str]:
    """A whole run, then a run for the first quarter whose trips are all cancelled by now."""
    store, root = FolderStore(new_path(spark, "store")), new_path(spark, "processed")
    trips = csv_scan_all_string(spark, sf_dir)
    lookups = csv_lookup_carriers(spark, sf_dir), csv_lookup_airports(spark, sf_dir)
    run(spark, trips, *lookups, store, root)
    run(spark, trips.withColumn("CANCELLED", F.lit("1")), *lookups, store, root, "Q1")
    return store, root


@query(_ALL_RAW + _table_sql("airline_features") + " HAVING quarter <> 'Q1'")
def run_store_quarter_emptied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter that has lost all its trips leaves the store."""
    store, _ = _without_first_quarter(spark, sf_dir)
    return store.read(spark, "airline_features").drop("processed_at")


@query(_ALL_RAW + f"SELECT {ID}, quarter FROM enriched WHERE quarter <> 'Q1'")
def lake_quarter_emptied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter that has lost all its trips leaves the processed lake."""
    _, root = _without_first_quarter(spark, sf_dir)
    return read_processed(spark, root).select(*TRIP_ID, "quarter")


@query(
    _with(_RAW, _LANDED) + "SELECT message_key, airline, corrupt_value FROM landed "
    "UNION ALL SELECT message_key, NULL, '{' || message_key FROM landed"
)
def stream_land_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message is followed by one that is no JSON, whose text stays in the lake."""
    topic = new_path(spark, "topic")
    publish(_messages(spark, sf_dir), "parquet", {"path": topic})
    # Only the keys are read back: the messages are made once.
    sent = spark.read.schema(MESSAGE_TOPIC).parquet(topic)
    broken = sent.select("key", F.concat(F.lit("{"), "key").alias("value"))
    publish(broken, "parquet", {"path": topic})
    landed = read_raw(spark, _land_twice(spark, topic))
    return landed.select("message_key", "airline", "corrupt_value")


_GROUP_COUNTS = " + ".join(
    f"(SELECT count(*) FROM ({_table_sql(name)}))" for name in FEATURE_TABLES
)


@query(
    _ALL_RAW + f", groups AS (SELECT {_GROUP_COUNTS} AS n) "
    ", codes AS (SELECT (SELECT count(*) FROM carriers) + (SELECT count(*) FROM airports) AS n) "
    "SELECT 'lookups' AS stage, 'SUCCESS' AS status, n AS records_in, n AS records_out FROM codes "
    "UNION ALL SELECT 'clean', 'SUCCESS', (SELECT count(*) FROM raw), "
    "(SELECT count(*) FROM cleaned) "
    "UNION ALL SELECT 'process', 'SUCCESS', (SELECT count(*) FROM raw), "
    "(SELECT count(*) FROM enriched) "
    "UNION ALL SELECT 'aggregate', 'SUCCESS', (SELECT count(*) FROM enriched), n FROM groups "
    "UNION ALL SELECT 'load', 'SUCCESS', n, n FROM groups "
    + " ".join(
        f"UNION ALL SELECT 'load_{name}', 'SUCCESS', count(*), count(*) FROM ({_table_sql(name)})"
        for name in FEATURE_TABLES
    )
)
def run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _run_all(spark, sf_dir).read(spark, RUN_LOG)
    return log.select("stage", "status", "records_in", "records_out")


@query(_ALL + _table_sql("airport_features") + " HAVING quarter = 'Q2' AND origin_airport = '4'")
def feature_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = FolderStore(new_path(spark, "store"))
    groups = feature_groups(_grouped_input(spark, sf_dir), _lookups(spark, sf_dir))
    load_features(groups.tables(), store)
    return lookup_features(spark, store, "airport_features", "Q2", origin_airport="4")


@query(_ALL + _table_sql("route_features") + " HAVING quarter = 'Q3' AND origin_airport = '7'")
def feature_lookup_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the second index of the table, whose values its files do not lie sorted by."""
    store = FolderStore(new_path(spark, "store"))
    groups = feature_groups(_grouped_input(spark, sf_dir), _lookups(spark, sf_dir))
    load_features(groups.tables(), store)
    return lookup_features(spark, store, "route_features", "Q3", origin_airport="7")


@query(
    _ALL + "SELECT 'raw' AS stage, (SELECT count(*) FROM trips) AS rows "
    "UNION ALL SELECT 'clean', (SELECT count(*) FROM cleaned) "
    "UNION ALL SELECT 'enriched', (SELECT count(*) FROM enriched)"
)
def stage_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of three stages, taken while one job runs through all of them."""
    raw, raw_rows = counted(fixture.trips(spark, sf_dir), "raw")
    cleaned, clean_rows = counted(raw.transform(cleaning.clean), "clean")
    joined, joined_rows = counted(cleaned.transform(enrich, _lookups(spark, sf_dir)), "enriched")
    joined.write.format("noop").mode("overwrite").save()
    seen = {"raw": raw_rows, "clean": clean_rows, "enriched": joined_rows}
    counts = [(stage, rows_seen(observation)) for stage, observation in seen.items()]
    return spark.createDataFrame(counts, "stage string, rows long")
