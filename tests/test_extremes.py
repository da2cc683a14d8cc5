"""Largest readings."""

import math

import pytest

from clickloom.operators.extremes import extremes_report, largest, reading_lines
from clickloom.schemas import READING_SCHEMA
from clickloom.sources.events import read_readings

ROWS = [
    # STATION, DATE, LATITUDE, LONGITUDE, ELEVATION, NAME, MAX, TEMP, GUST, WDSP, PRCP
    ("1", "2024-01-01", 1.0, 2.0, 3.0, "ONE", 9999.9, 50.5, None, 999.9, 99.99),
    ("2", "2024-01-02", 1.0, 2.0, 3.0, "TWO", 88.0, None, float("nan"), 10.0, 99.99),
    ("3", "2024-01-03", 1.5, 2.5, 3.0, "TRE", 88.0, 20.0, 30.5, 11.5, 99.99),
    ("0", "2024-01-04", 1.0, 2.0, 3.0, "NIL", 87.0, 99.99, 999.9, 1.0, None),
]


@pytest.fixture
def readings(spark):
    return spark.createDataFrame(ROWS, READING_SCHEMA)


def test_largest_skips_sentinels_nulls_and_nan(readings):
    assert largest(readings, "MAX").collect()[0].STATION == "3"      # tie: larger key
    assert largest(readings, "GUST").collect()[0].GUST == 30.5
    assert largest(readings, "PRCP").collect() == []
    assert largest(readings, "MAX").columns == [
        "STATION", "DATE", "LATITUDE", "LONGITUDE", "ELEVATION", "NAME", "MAX"]
    assert [r.STATION for r in largest(readings, "MAX", n=3).collect()] == ["3", "2", "0"]


def test_report_agrees_with_largest_in_one_pass(readings):
    report = {r.column_name: r for r in extremes_report(readings).collect()}
    assert len(report) == 5
    for column in ("MAX", "TEMP", "GUST", "WDSP"):
        row = largest(readings, column).first()
        assert report[column].value == row[column]
        assert report[column].STATION == row.STATION
    assert report["PRCP"].value is None and report["PRCP"].NAME is None
    assert report["MAX"].units == "°F" and report["MAX"].description == "Highest temperature"


def test_sentinels_per_column(readings):
    report = {r.column_name: r.value for r in extremes_report(
        readings, overrides={"TEMP": [], "GUST": [999.9]}).collect()}
    assert report["TEMP"] == 99.99 and report["GUST"] == 30.5


def test_report_lines(readings):
    lines = {r.column_name: r.line for r in reading_lines(extremes_report(readings)).collect()}
    assert lines["MAX"] == "Highest temperature: 88.0°F on 2024-01-03 at TRE (1.5, 2.5)"


def test_csv_with_given_and_inferred_schema(spark, readings, tmp_path):
    readings.write.csv(str(tmp_path / "2024"), header=True)
    given = read_readings(spark, str(tmp_path / "2024"))
    inferred = read_readings(spark, str(tmp_path / "2024"), infer=True)
    assert given.count() == inferred.count() == 4
    assert dict(inferred.dtypes)["MAX"] == "double"
    assert {r.column_name: r.value for r in extremes_report(given).collect()} == {
        "MAX": 88.0, "TEMP": 50.5, "GUST": 30.5, "WDSP": 11.5, "PRCP": None}
    assert any(math.isnan(r.GUST) for r in given.collect() if r.GUST is not None)


def test_integer_columns(spark):
    df = spark.createDataFrame([(1, 5), (2, 7), (3, 99)], "k INT, v INT")
    assert largest(df, "v", ["k"], sentinels=[99]).first().k == 2


def test_large_numbers_decimals_and_two_statistics_of_one_column(spark):
    from decimal import Decimal
    big = 2 ** 53
    df = spark.createDataFrame(
        [(1, big + 1, Decimal("0.10000000000000000002")), (2, big, Decimal("0.10000000000000000001"))],
        "k INT, v BIGINT, d DECIMAL(38,20)")
    report = extremes_report(df, [("A", "v", ""), ("B", "v", "")], ["k"], sentinels=[]).collect()
    assert [(r.description, r.k, r.value) for r in report] == [("A", 1, big + 1), ("B", 1, big + 1)]
    assert largest(df, "v", ["k"], sentinels=[]).first().k == 1
    top = extremes_report(df, [("D", "d", "")], ["k"], sentinels=[]).first()
    assert (top.k, top.value) == (1, Decimal("0.10000000000000000002"))
