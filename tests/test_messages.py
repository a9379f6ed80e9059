"""Messages: who is published, their keys and values, and the way back."""

from __future__ import annotations

import json


from contrail.operators.clean import clean
from contrail.operators.messages import from_messages, publish_stats, to_messages
from contrail.schemas import TRIP_COLUMNS
from contrail.sinks.topic import DELIVERY_OPTIONS, broker_options
from tests.trips import raw_trips, rows_of

AT = "2015-02-01T00:00:00"


def test_blank_number_or_time_is_skipped(spark):
    trips = raw_trips(
        spark, {}, {"flight_number": ""}, {"flight_number": None}, {"departure_time": ""},
        {"departure_time": None},
    )
    assert to_messages(trips, AT).count() == 1
    assert tuple(publish_stats(trips).first()) == (5, 1, 4)


def test_key_is_unpadded(spark):
    trips = raw_trips(spark, {"month": "1", "day": "11"}, {"month": "11", "day": "1"})
    assert {r.key for r in to_messages(trips, AT).collect()} == {"AA-98-2015111"}


def test_key_keeps_the_place_of_a_blank_part(spark):
    assert to_messages(raw_trips(spark, {"airline": None}), AT).first().key == "-98-201514"


def test_absent_columns_have_defaults_in_the_key_and_null_in_the_value(spark):
    trips = raw_trips(spark, {}).drop("airline", "year", "month", "day")
    message = to_messages(trips, AT).first()
    assert message.key == "X-98-20150101"
    assert json.loads(message.value)["airline"] is None


def test_value_holds_every_column_as_text(spark):
    value = json.loads(to_messages(raw_trips(spark, {"tail_number": 'N"é\\1'}), AT).first().value)
    assert list(value) == [*TRIP_COLUMNS, "ingested_at"]
    assert value["tail_number"] == 'N"é\\1' and value["wheels_off"] == ""
    assert value["distance"] == "2279" and value["ingested_at"] == "2015-02-01T00:00:00"


def test_ingestion_time_is_iso_text(spark):
    value = json.loads(to_messages(raw_trips(spark, {})).first().value)
    from datetime import UTC, datetime

    sent = datetime.fromisoformat(value["ingested_at"]).replace(tzinfo=UTC)
    assert abs((datetime.now(UTC) - sent).total_seconds()) < 600


def test_round_trip_cleans_like_the_file(spark):
    trips = raw_trips(spark, {}, {"airline": None, "weather_delay": "3"}, {"day": "5.0"})
    landed = from_messages(to_messages(trips, AT))
    assert dict(landed.dtypes)["year"] == "int"
    columns = [c for c in clean(trips).columns]
    assert rows_of(clean(landed).select(columns)) == rows_of(clean(trips))


def test_broken_message_is_kept(spark):
    broken = spark.createDataFrame([("k", "{not json")], "key string, value string")
    row = from_messages(broken).first()
    assert row.message_key == "k" and row.year is None and row.airline is None
    assert row.corrupt_value == "{not json"


def test_broker_options():
    options = broker_options("host:9092", "trips")
    assert options["kafka.bootstrap.servers"] == "host:9092" and options["topic"] == "trips"
    assert options.items() >= DELIVERY_OPTIONS.items()
