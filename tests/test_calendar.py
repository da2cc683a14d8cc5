"""Calendar keys: literal expectations around midnight, week and year ends."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickloom.functions.calendar import cast_columns, day_ms, instant_of, with_calendar

D = dt.date


def keys(spark, text, **options):
    df = spark.createDataFrame([(text,)], "timestamp STRING")
    return with_calendar(df, "timestamp", **options).first()


def test_raw_basis_formats_the_utc_day_and_local_basis_the_local_one(spark):
    row = keys(spark, "2024-01-01T20:00:00Z")
    assert row.local_timestamp == dt.datetime(2024, 1, 2, 5)
    assert (row.ym, row.ymd) == ("2024-01", "2024-01-01")
    row = keys(spark, "2024-01-31T20:00:00Z", basis="local")
    assert (row.ym, row.ymd) == ("2024-02", "2024-02-01")


@pytest.mark.parametrize("local_day, plain, iso", [
    # The week belongs to the day after the local day.
    ("2022-01-01", "2022-52", "2021-52"),
    ("2024-12-30", "2024-1", "2025-01"),
    ("2024-02-14", "2024-7", "2024-07"),
])
def test_year_week(spark, local_day, plain, iso):
    text = f"{local_day}T00:30:00Z"
    assert keys(spark, text, zone="UTC").yw == plain
    assert keys(spark, text, zone="UTC", iso=True).yw == iso


@pytest.mark.parametrize("day, sunday", [
    (D(2024, 1, 6), D(2023, 12, 31)),   # Saturday: the next day is still in this week
    (D(2024, 1, 7), D(2024, 1, 7)),     # Sunday opens its own week
    (D(2024, 1, 8), D(2024, 1, 7)),     # Monday
])
def test_week_key_is_the_opening_sunday_or_yesterday(spark, day, sunday):
    text = f"{day}T12:00:00Z"
    assert keys(spark, text, zone="UTC").ywd == sunday
    assert keys(spark, text, zone="UTC", week_key="yesterday").ywd == day - dt.timedelta(days=1)


def test_local_midnight_moves_the_day(spark):
    assert keys(spark, "2024-01-01T14:59:59Z").next_local_day == D(2024, 1, 2)
    assert keys(spark, "2024-01-01T15:00:00Z").next_local_day == D(2024, 1, 3)


def test_text_that_is_no_time_gives_nulls(spark):
    row = keys(spark, "yesterday-ish")
    assert row.timestamp == "yesterday-ish"
    assert [row[c] for c in ("local_timestamp", "ywd", "yw", "ym", "ymd")] == [None] * 5


def test_results_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    expected = keys(spark, "2024-03-10T07:30:00.123456Z")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert keys(spark, "2024-03-10T07:30:00.123456Z") == expected
        zoned = spark.createDataFrame([("2024-03-10T07:30:00.123456Z",)], "timestamp STRING").select(
            F.col("timestamp").cast("timestamp"))
        assert with_calendar(zoned).first().local_timestamp == expected.local_timestamp
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert expected.local_timestamp == dt.datetime(2024, 3, 10, 16, 30, 0, 123456)


@pytest.mark.parametrize("clock", [
    dt.datetime(2024, 3, 10, 2, 30, 0, 123456),      # skipped by clocks in New York
    dt.datetime(2024, 11, 3, 1, 30),                 # twice in New York
    dt.datetime(1969, 12, 31, 23, 59, 58, 900000), dt.datetime(1955, 5, 5, 5, 5, 5)])
def test_zone_less_times_are_utc_under_any_session_zone(spark, clock):
    before = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame([(clock,)], "t TIMESTAMP_NTZ")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = with_calendar(df, "t", zone="Etc/GMT-9").first()
        micros = df.select(F.unix_micros(instant_of(df, "t"))).first()[0]
        day = df.select(day_ms(df, "t")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    since = clock - dt.datetime(1970, 1, 1)
    assert row.local_timestamp == clock + dt.timedelta(hours=9)
    assert (row.ym, row.ymd) == (f"{clock:%Y-%m}", f"{clock:%Y-%m-%d}")
    assert micros == since // dt.timedelta(microseconds=1)
    assert day == since.days * 86_400_000


def test_conversion_the_other_way(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 5),)], "t TIMESTAMP_NTZ")
    row = with_calendar(df, "t", "UTC", source_zone="Asia/Seoul", iso=True, basis="local").first()
    assert row.local_timestamp == dt.datetime(2024, 1, 1, 20)
    assert (row.ymd, row.yw, row.ywd) == ("2024-01-01", "2024-01", D(2023, 12, 31))
    day = spark.createDataFrame([(D(2024, 7, 1),)], "t DATE")
    row = with_calendar(day, "t", "UTC", source_zone="Europe/Paris").first()
    assert row.local_timestamp == dt.datetime(2024, 6, 30, 22) and row.ymd == "2024-07-01"


def test_other_zones_and_options_are_checked(spark):
    assert keys(spark, "2024-07-01T12:00:00Z", zone="Europe/Paris").local_timestamp.hour == 14
    with pytest.raises(ValueError):
        keys(spark, "2024-07-01T12:00:00Z", basis="other")
    with pytest.raises(ValueError):
        keys(spark, "2024-07-01T12:00:00Z", week_key="other")
    with pytest.raises(ValueError):
        with_calendar(spark.range(1), "timestamp")


def test_day_key_is_utc_midnight_in_milliseconds(spark):
    df = spark.createDataFrame([("2022-05-12T23:59:59Z",), ("1969-12-31T12:00:00Z",)], "t STRING")
    assert [r[0] for r in df.select(day_ms(df, "t")).collect()] == [1652313600000, -86400000]


def test_bulk_cast_skips_absent_columns_and_bad_values(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00", "no", "x")], "timestampAt STRING, timestamp STRING, o STRING")
    row = cast_columns(df).first()
    assert row.timestampAt == dt.datetime(2024, 1, 1)
    assert row.timestamp is None and row.o == "x"
    assert cast_columns(df, ["none"]).columns == df.columns
