from datetime import datetime

from helpers import T0, frame, rows_of, trip
from pyspark.sql import functions as F

from tripweave.operators import messages
from tripweave.schemas import TRIP

GOOD = (
    '{"ride_id":"1","event_time":"2024-01-10T08:00:00","ingest_time":"2024-01-10T08:00:01.5","dropoff_time":"2024-01-10T08:10:00",'
    '"pickup_zone":"1","dropoff_zone":"2","distance_km":2.0,"fare_usd":10.0,"payment_type":"card"}'
)


def topic(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "text string").select(
        F.lit("k").cast("binary").alias("key"), F.col("text").cast("binary").alias("value")
    )


def test_decode_undoes_encode(spark):
    trips = frame(
        spark,
        [
            trip("a", event=datetime(2024, 1, 1, 0, 0, 0, 1)),
            trip("b", fare=None, distance=None, payment=None),
            trip('quote " and \\ and ü', distance=1e-7, fare=1.2345678901234567e19),
            trip("c", minutes=None),
        ],
    )
    back = messages.decode(messages.encode(trips))
    assert rows_of(back) == rows_of(trips) and back.columns == TRIP.names


def test_iso_text_drops_a_zero_fraction_and_keeps_all_fields(spark):
    row = messages.encode(frame(spark, [trip("a", event=T0, ingest=datetime(2024, 1, 10, 8, 0, 0, 50), fare=None)])).first()
    assert bytes(row.key) == b"a"
    text = bytes(row.value).decode()
    assert '"event_time":"2024-01-10T08:00:00"' in text
    assert '"ingest_time":"2024-01-10T08:00:00.000050"' in text
    assert '"fare_usd":null' in text


def test_bad_messages_become_nulls(spark):
    bad = ["plain text", GOOD[:60], "{}", "[1]", None, "", GOOD.replace('"2024-01-10T08:00:00"', '"NaT"')]
    rows = messages.decode(topic(spark, bad)).collect()
    assert len(rows) == len(bad)
    assert all(v is None for r in rows[:1] + rows[2:6] for v in r)
    assert rows[6].event_time is None and rows[6].ride_id == "1"


def test_odd_but_good_messages(spark):
    odd = [
        GOOD.replace('"distance_km":2.0', '"distance_km":NaN'),
        GOOD.replace('"ride_id":"1"', '"ride_id":1'),
        GOOD.replace("08:00:00\"", '08:00:00+02:00"'),
        GOOD.replace('"card"', '" unknown"'),
        GOOD[:-1] + ',"extra":1}',
    ]
    checked = messages.decode_checked(topic(spark, odd))
    assert messages.quarantined(checked).count() == 0
    rows = messages.accepted(checked).collect()
    assert rows[0].distance_km != rows[0].distance_km
    assert rows[1].ride_id == "1"
    assert rows[2].event_time == datetime(2024, 1, 10, 6)
    assert rows[3].payment_type == " unknown"


def test_quarantine_names_the_reason(spark):
    cases = {
        "plain text": "malformed",
        GOOD[:60]: "malformed",
        "[1]": "malformed",
        GOOD.replace('"2024-01-10T08:00:00"', '"NaT"'): "malformed",
        GOOD.replace('"fare_usd":10.0', '"fare_usd":"10.0"'): "malformed",
        "{}": "missing: ride_id,event_time,ingest_time,dropoff_time",
        GOOD.replace('"ride_id":"1",', ""): "missing: ride_id",
        "": "empty",
    }
    checked = messages.decode_checked(topic(spark, [*cases, None, GOOD]))
    assert messages.accepted(checked).count() == 1
    got = {r.raw: r.reject_reason for r in messages.quarantined(checked).collect()}
    assert got == {**cases, None: "empty"}


def test_decoding_leaves_the_schema_alone(spark):
    before = TRIP.json()
    messages.decode_checked(topic(spark, [GOOD])).collect()
    assert TRIP.json() == before


def test_checked_decode_parses_each_message_once(spark):
    from helpers import plan_of

    plan = plan_of(messages.accepted(messages.decode_checked(topic(spark, [GOOD]))))
    assert plan.count("from_json") == 1
