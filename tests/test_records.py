from __future__ import annotations

import hashlib
import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgermill.functions import (
    day_to_millis,
    event_date,
    event_hour,
    event_timestamp,
    ingest_date,
    payload_json,
    row_id,
    step_day_index,
)
from ledgermill.schema import epoch_seconds
from tests.records import bronze, record

ZONES = ["UTC", "Asia/Seoul", "America/New_York", "Asia/Kolkata"]


@pytest.mark.parametrize("zone", ZONES)
def test_event_time_does_not_depend_on_the_session_zone(spark, session_conf, zone):
    session_conf("spark.sql.session.timeZone", zone)
    steps = spark.createDataFrame([(1,), (24,), (25,), (743,)], "step int")
    rows = steps.select(
        F.unix_seconds(event_timestamp(F.col("step"))).alias("seconds"),
        event_date(F.col("step")).alias("day"),
    ).collect()
    begin = epoch_seconds()
    assert [row.seconds - begin for row in rows] == [0, 23 * 3600, 24 * 3600, 742 * 3600]
    assert [row.day for row in rows] == [
        date(2016, 1, 1),
        date(2016, 1, 1),
        date(2016, 1, 2),
        date(2016, 1, 31),
    ]


@pytest.mark.parametrize("zone", ZONES)
def test_event_hour_is_the_utc_hour(spark, session_conf, zone):
    session_conf("spark.sql.session.timeZone", zone)
    df = spark.createDataFrame([(3599,), (3600,), (-1,)], "s bigint")
    hours = df.select(F.unix_seconds(event_hour(F.timestamp_seconds("s")))).collect()
    assert [row[0] for row in hours] == [0, 3600, -3600]



def test_times_out_of_range_are_null(spark):
    from ledgermill.functions import millis_to_timestamp

    values = [(0,), (2**63 - 1,), (-(2**63),), ((2**63 - 1) // 1000,), (None,)]
    rows = spark.createDataFrame(values, "m long").select(
        F.unix_millis(millis_to_timestamp("m")).alias("t")
    )
    assert [r.t for r in rows.collect()] == [0, None, None, (2**63 - 1) // 1000, None]


def test_another_epoch(spark):
    steps = spark.createDataFrame([(1,), (2,)], "step int")
    days = steps.select(event_date(F.col("step"), "2020-02-28 23:00:00")).collect()
    assert [row[0] for row in days] == [date(2020, 2, 28), date(2020, 2, 29)]


@pytest.mark.parametrize("zone", ZONES)
def test_ingest_date_is_the_utc_day(spark, session_conf, zone):
    session_conf("spark.sql.session.timeZone", zone)
    millis = [0, 86399999, 86400000, -1, None, 1 << 62]
    df = spark.createDataFrame([(m,) for m in millis], "m bigint")
    days = [row[0] for row in df.select(ingest_date("m")).collect()]
    expected = [date(1970, 1, 1), date(1970, 1, 1), date(1970, 1, 2), date(1969, 12, 31)]
    assert days == expected + [None, None]


def test_day_to_millis(spark):
    df = spark.createDataFrame([(date(2016, 1, 2),)], "d date")
    expected = int((datetime(2016, 1, 2) - datetime(1970, 1, 1)).total_seconds() * 1000)
    assert df.select(day_to_millis("d")).first()[0] == expected


def test_row_id_hashes_the_raw_text(spark):
    got = bronze(spark, record(), record(amount="10.0")).select(row_id()).collect()
    expected = [
        hashlib.sha256(f"C1|1|PAYMENT|{amount}|M1".encode()).hexdigest()
        for amount in ("10.00", "10.0")
    ]
    assert [row[0] for row in got] == expected


def test_payload_json_keeps_the_record(spark):
    df = bronze(spark, record(amount=None, nameOrig="Ç\"1"))
    value = json.loads(df.select(payload_json(df.columns)).first()[0])
    expected = record(nameOrig="Ç\"1")
    del expected["amount"], expected["kafka_timestamp"]
    assert value == expected


def test_payload_json_prefers_unreadable_text(spark):
    df = bronze(spark, record()).withColumn("_corrupt_record", F.lit("{broken"))
    assert df.select(payload_json(df.columns)).first()[0] == "{broken"


def test_step_day_index(spark):
    df = spark.createDataFrame([("0",), ("1",), ("24",), ("25",), ("x",)], "step string")
    assert [row[0] for row in df.select(step_day_index("step")).collect()] == [-1, 0, 0, 1, None]
