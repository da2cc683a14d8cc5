"""Ledger, changed files and rejected lines of the ingest; rejects of the daily job."""

import json
import os
import time

import pytest

from clickloom.operators.flatten import flatten_event
from clickloom.plans.daily import daily_load
from clickloom.schemas import event_schema
from clickloom.sources.events import read_events
from clickloom.sources.files import file_inventory
from clickloom.sources.rejects import read_accepted, read_rejects, split_metrics, write_split
from clickloom.streaming.ingest import (
    ChangedFiles, ingest_available, ledger_of, read_ingested, read_ingested_rejects)
from clickloom.streaming.ledger import file_status, read_ledger


def put(root, name, ids, extra=()):
    path = root / "src" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([json.dumps({"messageId": i, "timestamp": "2024-01-01T10:00:00Z"}) for i in ids] + list(extra)))
    return path


def later(path, seconds=60):
    moment = time.time() + seconds
    os.utime(path, (moment, moment))


@pytest.fixture
def job(spark, tmp_path):
    paths = [str(tmp_path / p) for p in ("dw", "check", "state")]

    def run(**options):
        ingest_available(spark, f"{tmp_path}/src/*", *paths, **options)
        return sorted(r.messageId for r in read_ingested(spark, paths[0]).collect())

    return run, paths


def test_rewritten_file_is_refused_or_replaces_its_rows(spark, tmp_path, job):
    run, (target, _, _) = job
    a = put(tmp_path, "d 1+é/a.json", ["m1", "m2"])
    put(tmp_path, "d2/b.json", ["m3"])
    assert run() == ["m1", "m2", "m3"]
    put(tmp_path, "d 1+é/a.json", ["m1", "m9"])
    later(a)
    put(tmp_path, "d2/c.json", ["m4"])
    with pytest.raises(ChangedFiles, match="1 loaded files"):
        run()
    assert sorted(r.messageId for r in read_ingested(spark, target).collect()) == ["m1", "m2", "m3"]
    assert run(changed="reload") == ["m1", "m3", "m4", "m9"]
    assert run() == ["m1", "m3", "m4", "m9"]          # loaded again once
    put(tmp_path, "d 1+é/a.json", ["m7"])
    later(a, 120)
    assert run(changed="reload") == ["m3", "m4", "m7"]
    assert read_ledger(spark, ledger_of(target)).count() == 5


def test_failed_reload_shows_no_rows_twice(spark, tmp_path, job, monkeypatch):
    from clickloom.streaming import ingest
    run, (target, _, _) = job
    a = put(tmp_path, "d/a.json", ["m1", "m2"])
    run()
    put(tmp_path, "d/a.json", ["m1"])
    later(a)
    write = ingest.write_table

    def fail(df, path, *args, **options):
        if "_ledger" in path:
            raise RuntimeError("lost")
        write(df, path, *args, **options)

    monkeypatch.setattr(ingest, "write_table", fail)
    with pytest.raises(RuntimeError):
        run(changed="reload")
    monkeypatch.undo()
    assert sorted(r.messageId for r in read_ingested(spark, target).collect()) == ["m1", "m2"]
    assert run(changed="reload") == ["m1"]


def test_status_of_files(spark, tmp_path, job):
    run, (target, _, _) = job
    gone, changed = put(tmp_path, "d/gone.json", ["m1"]), put(tmp_path, "d/changed.json", ["m2"])
    put(tmp_path, "d/same.json", ["m3"])
    run()
    gone.unlink()
    later(changed)
    put(tmp_path, "d/new.json", ["m4"])
    status = file_status(file_inventory(spark, str(tmp_path / "src")), read_ledger(spark, ledger_of(target)))
    assert {os.path.basename(r.path): r.status for r in status.collect()} == {
        "gone.json": "vanished", "changed.json": "changed", "same.json": "loaded", "new.json": "new"}


def test_start_opens_no_data_file_of_the_target(spark, tmp_path, job):
    run, (target, _, _) = job
    put(tmp_path, "d/a.json", ["m1"])
    run()
    for folder, _, files in os.walk(target):
        for name in files:
            if name.endswith(".parquet"):
                open(os.path.join(folder, name), "w").close()   # would fail to open
    put(tmp_path, "d/b.json", ["m2"])
    ingest_available(spark, f"{tmp_path}/src/*", target, str(tmp_path / "check"), str(tmp_path / "state"))


def test_rejects_of_the_ingest(spark, tmp_path, job):
    run, (target, metrics, _) = job
    put(tmp_path, "d/a.json", ["m1"], ['{"messageId": "cut', "no json"])
    assert run(rejects=True) == ["m1"]
    b = put(tmp_path, "d/b.json", ["m2"], ["[1"])
    assert run(rejects=True) == ["m1", "m2"]
    rejected = read_ingested_rejects(spark, target)
    assert sorted((os.path.basename(r.file), r.text) for r in rejected.collect()) == [
        ("a.json", "no json"), ("a.json", '{"messageId": "cut'), ("b.json", "[1")]
    stored = spark.read.option("recursiveFileLookup", "true").json(metrics)
    totals = {r.metric: r["sum(value)"] for r in stored.groupBy("metric").sum("value").collect()}
    assert totals["DL_corrupt_count"] == 3 and totals["DL_pk_count"] == 5 and totals["DW_pk_count"] == 2
    put(tmp_path, "d/b.json", ["m2", "m3"])
    later(b)
    assert run(rejects=True, changed="reload") == ["m1", "m2", "m3"]
    assert read_ingested_rejects(spark, target).count() == 2
    with pytest.raises(ValueError, match="keep"):
        run(rejects=True, transform=lambda df: df)


def test_split_write_and_daily_job(spark, tmp_path):
    put(tmp_path, "a.json", ["m1", "m2"], ["{bad", "", "worse}"])
    raw = read_events(spark, str(tmp_path / "src"), event_schema(corrupt=True))
    target = str(tmp_path / "split")
    write_split(raw, target)
    flat = flatten_event(raw)
    assert read_accepted(spark, target, flat.schema).schema == flat.schema
    assert sorted(r.messageId for r in read_accepted(spark, target, flat.schema).collect()) == ["m1", "m2"]
    got = read_rejects(spark, target).collect()
    assert sorted((os.path.basename(r.file), r.block_start, r.text) for r in got) == [
        ("a.json", 0, "worse}"), ("a.json", 0, "{bad")]
    assert {r.metric: r.value for r in split_metrics(spark, target).collect()} == {
        "line_count": 4, "accepted_count": 2, "corrupt_count": 2}
    plan = read_accepted(spark, target, flat.schema)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rejected" in plan
    metrics = daily_load(spark, str(tmp_path / "src"), str(tmp_path / "dw"), str(tmp_path / "m"), rejects=True)
    values = {r.metric: r.value for r in metrics.collect()}
    assert (values["DL_pk_count"], values["DW_pk_count"], values["DL_corrupt_count"]) == (4, 2, 2)
