from datetime import datetime

import pytest
from pyspark.sql import functions as F

from playmart.functions import calendar_parts, epoch_to_timestamp
from playmart.sources.tables import _epoch_millis


def start_of(spark, millis):
    df = spark.createDataFrame([(millis,)], "ts bigint")
    return df.select(epoch_to_timestamp("ts").alias("start_time"))


@pytest.fixture
def los_angeles(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    yield
    spark.conf.set("spark.sql.session.timeZone", zone)


def test_milliseconds_are_dropped(spark):
    df = start_of(spark, 1541990258796)
    assert df.first().start_time == datetime(2018, 11, 12, 2, 37, 38)
    assert df.schema["start_time"].dataType.typeName() == "timestamp_ntz"


def test_division_truncates_toward_zero(spark):
    assert start_of(spark, -1500).first().start_time == datetime(1969, 12, 31, 23, 59, 59)


def test_null_time(spark):
    assert start_of(spark, None).first().start_time is None


def test_session_zone_has_no_effect(spark, los_angeles):
    row = start_of(spark, 1541990258796).select("start_time", F.hour("start_time").alias("hour")).first()
    assert (row.start_time, row.hour) == (datetime(2018, 11, 12, 2, 37, 38), 2)


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_epoch_millis_of_ntz_floors_in_any_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("SELECT timestamp_ntz'2018-11-04 01:30:00.796999' AS t").select(_epoch_millis("t").alias("ms"))
        assert df.first().ms == 1541295000796
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2018-11-11 00:00:00", (0, 11, 45, 11, 2018, 0)),
        ("2018-11-17 23:59:59", (23, 17, 46, 11, 2018, 6)),
        ("2018-12-31 13:05:00", (13, 31, 1, 12, 2018, 1)),
    ],
)
def test_calendar_parts(spark, text, expected):
    df = spark.sql(f"SELECT timestamp_ntz'{text}' AS start_time").select(*calendar_parts())
    assert df.columns == ["hour", "day", "week", "month", "year", "weekday"]
    assert tuple(df.first()) == expected
    assert {f.dataType.typeName() for f in df.schema} == {"integer"}
