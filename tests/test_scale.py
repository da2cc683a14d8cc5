"""Plans: what is read, what is shuffled, how a hot key is spread."""

import re

import pytest
from pyspark.sql import functions as F

from clickloom.operators.extremes import extremes_report, largest
from clickloom.operators.flatten import flatten_event
from clickloom.operators.numbering import number_rows
from clickloom.operators.reconcile import count_metrics
from clickloom.operators.sessions import assign_sessions, session_table
from clickloom.plans.tables import event_log
from clickloom.session import scratch_path, scratch_root
from clickloom.sources.events import metric_preview
from clickloom.sources.writers import write_table


@pytest.fixture
def events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet")


@pytest.fixture
def conf(spark):
    changed = {}

    def put(**values):
        for key, value in values.items():
            name = key.replace("__", ".")
            changed.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield put
    for name, value in changed.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan(df, run=False):
    if run:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[:text.index("Initial Plan")] if "Initial Plan" in text else text


def test_sessions_read_two_columns_and_combine_before_the_first_shuffle(events):
    text = plan(session_table(events, "user_id", "ts", drop_null_ts=True))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text
    assert text.count("Exchange ") == 2
    first = text.index("Exchange ", text.index("Exchange ") + 1)
    assert "partial_min" in text[first:] and "Window" not in text[first:]


def test_flattening_does_not_shuffle(events):
    assert "Exchange" not in plan(flatten_event(event_log(events)))
    assert "BatchEvalPython" not in plan(flatten_event(event_log(events)))


def test_flattened_parquet_reads_only_the_fields_asked_for(spark, events, tmp_path):
    event_log(events).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    text = plan(flatten_event(log).select("context_page_url", "ymd").filter("context_page_url = '/view'"))
    assert "ReadSchema: struct<context:struct<page:struct<url:string>>,timestamp:string>" in text
    assert re.search(r"PushedFilters: \[[^\]]*context\.page\.url", text)


def test_distinct_count_combines_before_the_shuffle(events):
    text = plan(count_metrics(events, "user_id"))
    assert text.count("Exchange ") == 2
    assert "Exchange SinglePartition" in text
    assert "partial" in text[text.rindex("Exchange hashpartitioning"):]


def test_extremes_are_one_scan_and_a_top_one_needs_no_full_sort(events):
    stats = [("a", "value", "x"), ("b", "event_id", "y")]
    text = plan(extremes_report(events, stats, ["user_id"]))
    assert text.count("FileScan") == 1 and text.count("Exchange ") == 1
    assert "TakeOrderedAndProject" in plan(largest(events, "value", ["user_id"]))


def test_preview_limits_each_file_before_the_shuffle(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"metric":"m","value":1}\n')
    text = plan(metric_preview(spark, str(tmp_path)))
    assert "WindowGroupLimit" in text[text.rindex("Exchange hashpartitioning"):]


def test_hot_slot_is_split_when_sessions_are_joined_back(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
         spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
         spark__sql__adaptive__advisoryPartitionSizeInBytes="64k")
    rows = spark.range(200_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("u"),
        F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'").alias("t"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    assigned = assign_sessions(rows, "u", "t", drop_null_ts=True)
    text = plan(assigned, run=True)
    assert "skew=true" in text and "skewed" in text
    assert assigned.count() == 200_000


def test_large_folder_is_written_by_several_tasks_and_small_ones_by_few(spark, conf, tmp_path):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="400k")
    rows = spark.range(60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("day"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    write_table(rows, str(tmp_path / "plain"), partition_by=["day"])
    assert len(list((tmp_path / "plain").glob("day=*/*.parquet"))) == 8 * 40
    write_table(rows, str(tmp_path / "even"), partition_by=["day"], rebalance=True)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "even").glob("day=*")}
    small = [n for name, n in files.items() if name != "day=0"]
    assert files["day=0"] > 1
    assert len(small) == 39 and sum(small) < 3 * len(small)
    assert spark.read.parquet(str(tmp_path / "even")).count() == 60_000


def test_numbering_is_dense_per_key_and_keeps_hot_keys_apart(spark):
    rows = spark.range(10_000, numPartitions=16).selectExpr("IF(id % 3 = 0, NULL, id % 7) AS k", "id")
    got = number_rows(rows, ["k"], "n")
    assert got.count() == 10_000
    per_key = got.groupBy("k").agg(
        F.count_distinct("n").alias("d"), F.min("n").alias("lo"), F.max("n").alias("hi"),
        F.count(F.lit(1)).alias("c"))
    assert per_key.filter("d <> c OR lo <> 1 OR hi <> c").isEmpty()
    assert number_rows(rows.limit(0), ["k"], "n").isEmpty()


def test_scratch_folders_are_fresh_and_below_the_configured_root(spark):
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two and one.startswith(scratch_root(spark) + "/")


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session())
