"""Counts before and after a write."""

import datetime as dt

import pytest

from clickloom.operators.reconcile import compare, count_metrics, metric_lines, reconcile
from clickloom.plans.daily import daily_load
from clickloom.schemas import METRIC_SCHEMA
from clickloom.sources.events import join_path, metric_preview
from clickloom.sources.writers import read_back, write_counted, write_table


def metrics(df):
    return {r.metric: r.value for r in df.collect()}


def test_null_keys_count_as_rows_and_as_one_distinct_value(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "k STRING")
    assert metrics(count_metrics(df, "k", "DL", extra=True)) == {
        "DL_pk_count": 4, "distinct_DL_pk_count": 2, "DL_total_row_count": 4, "DL_null_pk_count": 2}


def test_empty_table(spark):
    df = spark.createDataFrame([], "k STRING")
    assert metrics(count_metrics(df, "k")) == {
        "pk_count": 0, "distinct_pk_count": 0, "total_row_count": 0}


def test_six_metrics_and_four(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k STRING")
    six = reconcile(df, df.limit(1), "k")
    assert six.columns == ["metric", "value"]
    assert metrics(six) == {
        "DL_pk_count": 2, "distinct_DL_pk_count": 2, "DL_total_row_count": 2,
        "DW_pk_count": 1, "distinct_DW_pk_count": 1, "DW_total_row_count": 1}
    assert len(metrics(reconcile(df, df, "k", distinct=False))) == 4
    assert {r.metric: r.matches for r in compare(df, df.limit(1), "k").collect()} == {
        "pk_count": False, "distinct_pk_count": False, "total_row_count": False}
    assert "DL_pk_count: 2" in {r.line for r in metric_lines(six).collect()}


def test_hot_key(spark):
    df = spark.range(100_000, numPartitions=8).selectExpr(
        "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS k")
    assert metrics(count_metrics(df, "k"))["distinct_pk_count"] == 66_667


def test_read_back_keeps_null_columns_and_types(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", None, dt.datetime(2024, 1, 1), dt.date(2024, 1, 2))],
        "k STRING, n STRING, t TIMESTAMP_NTZ, d DATE")
    path = join_path(str(tmp_path), "out/")
    assert write_counted(df, path, "json") == 1
    assert spark.read.json(path).columns != df.columns
    back = read_back(spark, path, df.schema)
    assert back.schema == df.schema and back.collect() == df.collect()


def test_write_overwrites_and_partitions(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "id % 3 AS part")
    for _ in range(2):
        write_table(df, str(tmp_path / "t"), partition_by=["part"], rebalance=True)
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 100
    assert sorted(p.name for p in (tmp_path / "t").glob("part=*")) == ["part=0", "part=1", "part=2"]
    assert back.filter("part = 1").inputFiles() and back.filter("part = 1").count() == 33


def test_daily_load(spark, tmp_path):
    folder = tmp_path / "src" / "1704067200000"
    folder.mkdir(parents=True)
    target, stored = str(tmp_path / "dw"), str(tmp_path / "check")
    assert daily_load(spark, str(folder), target, stored) is None
    assert daily_load(spark, str(tmp_path / "absent"), target, stored) is None
    (folder / "a.json").write_text(
        '{"messageId":"m1","timestamp":"2024-01-01T20:00:00Z"}\n{"messageId":"m1"}\n{broken\n')
    result = metrics(daily_load(spark, str(folder), target, stored))
    assert result == {"DL_pk_count": 3, "distinct_DL_pk_count": 2, "DL_total_row_count": 3,
                      "DW_pk_count": 3, "distinct_DW_pk_count": 2, "DW_total_row_count": 3}
    assert metrics(spark.read.schema(METRIC_SCHEMA).json(stored)) == result


def test_metric_preview_takes_the_first_rows_of_each_json_file(spark, tmp_path):
    for name, rows in (("a.json", 7), ("b.json", 3), ("c.txt", 9)):
        (tmp_path / name).write_text(
            "".join(f'{{"metric":"{name}{i}","value":{i}}}\n' for i in range(rows)))
    got = metric_preview(spark, str(tmp_path)).orderBy("file_path", "row_in_file").collect()
    assert [r.metric for r in got] == [f"a.json{i}" for i in range(5)] + [f"b.json{i}" for i in range(3)]
    assert [r.row_in_file for r in got] == [1, 2, 3, 4, 5, 1, 2, 3]


@pytest.mark.parametrize("parts, expected", [
    (("s3a://b/", "/d/", "*"), "s3a://b/d/*"), (("/r", "", "x"), "/r/x")])
def test_join_path(parts, expected):
    assert join_path(*parts) == expected
