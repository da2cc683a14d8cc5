"""Incremental ingest and live sessions."""

import datetime as dt
import json

import pytest

from clickloom.operators.flatten import flatten_event
from clickloom.operators.sessions import session_table
from clickloom.schemas import METRIC_SCHEMA
from clickloom.sources.events import read_events
from clickloom.streaming.ingest import ingest_available, read_ingested
from clickloom.streaming.sessions import LateRows, stream_sessions, write_available

DAY = 86_400_000


def deliver(root, day, ids):
    folder = root / "src" / str(1704067200000 + day * DAY)
    folder.mkdir(parents=True)
    (folder / "a.json").write_text("\n".join(json.dumps({
        "messageId": i, "anonymousId": "u",
        "timestamp": f"2024-01-{day + 1:02d}T10:00:0{n}Z"}) for n, i in enumerate(ids)))


@pytest.fixture
def job(spark, tmp_path):
    paths = [str(tmp_path / p) for p in ("dw", "check", "state")]

    def run(**options):
        ingest_available(spark, f"{tmp_path}/src/*", *paths, **options)
        return read_ingested(spark, paths[0])

    return run, paths


def test_each_delivery_is_loaded_once_and_equals_the_batch_run(spark, tmp_path, job):
    run, (_, metrics, _) = job
    deliver(tmp_path, 0, ["m1", "m2"])
    assert run().count() == 2
    deliver(tmp_path, 1, ["m3", "m3", "m4"])
    loaded = run()
    assert run().count() == 5                       # nothing new: nothing repeated
    batch = flatten_event(read_events(spark, f"{tmp_path}/src/*"))
    columns = ["messageId", "timestamp", "yw", "ywd", "ymd"]
    assert sorted(map(tuple, loaded.select(columns).collect())) == sorted(
        map(tuple, batch.select(columns).collect()))
    stored = spark.read.schema(METRIC_SCHEMA).option("recursiveFileLookup", "true").json(metrics)
    totals = {r.metric: r.total for r in stored.groupBy("metric").agg(
        {"value": "sum"}).withColumnRenamed("sum(value)", "total").collect()}
    assert totals["DL_pk_count"] == totals["DW_pk_count"] == 5
    assert totals["distinct_DW_pk_count"] == 4


def test_failed_batch_is_repeated_without_loss_or_copies(spark, tmp_path, job):
    run, _ = job
    deliver(tmp_path, 0, ["m1", "m2"])
    run()
    deliver(tmp_path, 1, ["m3"])
    calls = []

    def failing(batch):
        calls.append(batch)
        raise RuntimeError("executor gone")

    with pytest.raises(Exception, match="executor gone"):
        run(transform=failing)
    assert calls
    assert sorted(r.messageId for r in run().collect()) == ["m1", "m2", "m3"]


def test_small_batches(spark, tmp_path, job):
    run, (target, _, _) = job
    for day in range(3):
        deliver(tmp_path, day, [f"m{day}"])
    assert run(max_files=1).count() == 3
    assert len(list((tmp_path / "dw").glob("query=*/batch_id=*/ymd=*"))) == 3
    pruned = read_ingested(spark, target).filter("ymd = '2024-01-02'")
    assert [r.messageId for r in pruned.collect()] == ["m1"]
    assert pruned.schema["ymd"].dataType.typeName() == "string"
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ymd" in plan


def at(minutes):
    return dt.datetime(2024, 1, 1, 23) + dt.timedelta(minutes=minutes)


def live(spark, tmp_path, deliveries, delay="1 hour"):
    source, target, state = (str(tmp_path / p) for p in ("in", "out", "state"))
    for rows in deliveries:
        spark.createDataFrame(rows, "u STRING, t TIMESTAMP_NTZ").write.mode("append").parquet(source)
        stream = spark.readStream.schema("u STRING, t TIMESTAMP_NTZ").parquet(source)
        write_available(stream_sessions(stream, "u", "t", delay=delay), target, state)
    return spark.read.parquet(target)


def test_session_over_midnight_and_two_deliveries(spark, tmp_path):
    got = live(spark, tmp_path, [
        [("a", at(0)), ("a", at(30)), ("b", at(59)), ("a", None)],
        [("a", at(60)), ("a", at(91)), ("z", at(100_000))]])
    assert sorted(map(tuple, got.filter("u <> 'z'").collect())) == [
        ("a", at(0), at(60), 3), ("a", at(91), at(91), 1), ("b", at(59), at(59), 1)]


def test_hot_user_agrees_with_the_table_version(spark, tmp_path):
    rows = [("hot", at(i % 600)) for i in range(3000)] + [("hot", at(5))] * 2000 + [
        (f"u{i}", at(i * 7)) for i in range(50)]
    got = live(spark, tmp_path, [rows, [("z", at(100_000))]]).filter("u <> 'z'")
    table = session_table(spark.createDataFrame(rows, "u STRING, t TIMESTAMP_NTZ"), "u", "t")
    assert sorted((r.u, r.session_start_at) for r in got.collect()) == sorted(
        (r.u, r.session_start_at) for r in table.collect())
    assert got.agg({"n_events": "sum"}).first()[0] == len(rows)


def test_hot_user_is_merged_before_the_shuffle(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("a", at(0))], "u STRING, t TIMESTAMP_NTZ").write.parquet(source)
    stream = stream_sessions(
        spark.readStream.schema("u STRING, t TIMESTAMP_NTZ").parquet(source), "u", "t")
    query = (stream.writeStream.format("noop").outputMode("append")
             .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    below_exchange = plan[plan.index("Exchange hashpartitioning"):]
    assert "MergingSessions" in below_exchange


def test_files_of_any_age_are_loaded(spark, tmp_path, job):
    import os
    import time
    run, _ = job
    deliver(tmp_path, 0, ["m1"])
    run()
    deliver(tmp_path, 1, ["m2"])
    run()
    deliver(tmp_path, 2, ["m3"])
    old = time.time() - 30 * 86_400
    os.utime(tmp_path / "src" / str(1704067200000 + 2 * DAY) / "a.json", (old, old))
    assert sorted(r.messageId for r in run().collect()) == ["m1", "m2", "m3"]


def test_target_of_another_checkpoint_is_refused(spark, tmp_path, job):
    run, (target, metrics, _) = job
    deliver(tmp_path, 0, ["m1"])
    run()
    with pytest.raises(ValueError, match="another checkpoint"):
        ingest_available(spark, f"{tmp_path}/src/*", target, metrics, str(tmp_path / "new state"))
    assert [r.messageId for r in run().collect()] == ["m1"]


def test_late_rows_are_reported(spark, tmp_path):
    day = 24 * 60
    with pytest.raises(LateRows, match="1 rows"):
        live(spark, tmp_path, [[("a", at(2 * day))], [("z", at(9 * day))], [("b", at(0))], [("z", at(99 * day))]])
    source, target, state = (str(tmp_path / p) for p in ("in", "out", "state"))
    stream = spark.readStream.schema("u STRING, t TIMESTAMP_NTZ").parquet(source)
    assert write_available(stream_sessions(stream, "u", "t"), target, state, allow_late=True) >= 0
