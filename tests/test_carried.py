"""Sessions carried over loads against the sessions of all events at once."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickloom.operators import carried
from clickloom.operators.carried import carried_sessions, load_sessions, loads
from clickloom.operators.sessions import session_table

SCHEMA = "u string, t timestamp_ntz, extra int"
BASE = datetime(2024, 1, 1)


def at(minutes):
    return BASE + timedelta(minutes=minutes)


def key(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def check(spark, root, parts):
    every = []
    for n, part in enumerate(parts):
        every += part
        assert load_sessions(spark.createDataFrame(part, SCHEMA), root, f"load {n}", "u", "t")
        wanted = session_table(spark.createDataFrame(every, SCHEMA), "u", "t")
        got = carried_sessions(spark, root)
        assert got.columns == wanted.columns
        assert key(got.collect()) == key(wanted.collect()), n


def test_days_in_order_and_over_midnight(spark, tmp_path):
    days = [[("a", at(1430), 1), ("b", at(10), 1)], [("a", at(1450), 1), ("a", at(1600), 1)], [("b", at(4000), 1)]]
    check(spark, str(tmp_path / "s"), days)


def test_late_events_join_split_and_shift_sessions(spark, tmp_path):
    check(spark, str(tmp_path / "s"), [
        [("a", at(m), 1) for m in (0, 100, 200, 300)] + [("b", at(5000), 1)],
        [("a", at(125), 1), ("a", at(150), 1), ("a", at(175), 1)],   # joins two sessions
        [("a", at(-500), 1), ("b", at(4990), 1)],                      # a new first one, an earlier start
        [("a", None, 1), ("c", None, 1), ("c", None, 1)],              # untimed events come first
        [("c", at(7), 1), (None, at(1), 1), (None, None, 1)],
        [(None, at(3), 1), ("a", at(310), 1), ("a", at(310), 1)],
        [("a", at(299), 1)],
    ])


def test_random_loads(spark, tmp_path):
    rng = random.Random(11)
    users = ["a", "b", "c", None]
    parts = [[(rng.choice(users), None if rng.random() < 0.02 else at(rng.randrange(6000) + rng.random()), 1)
              for _ in range(rng.choice([1, 15, 40]))] for _ in range(5)]
    check(spark, str(tmp_path / "s"), parts)


def test_name_once_settings_and_empty_loads(spark, tmp_path):
    root = str(tmp_path / "s")
    assert loads(spark, root) == []
    with pytest.raises(ValueError, match="no load"):
        carried_sessions(spark, root)
    empty = spark.createDataFrame([], SCHEMA)
    assert load_sessions(empty, root, "nothing", "u", "t") and carried_sessions(spark, root).count() == 0
    one = spark.createDataFrame([("a", at(1), 1)], SCHEMA)
    assert load_sessions(one, root, "day 1", "u", "t") and not load_sessions(one, root, "day 1", "u", "t")
    assert load_sessions(empty, root, "nothing again", "u", "t")
    assert [tuple(r) for r in carried_sessions(spark, root).collect()] == [("a-1", "a", at(1), None)]
    with pytest.raises(ValueError, match="were loaded with"):
        load_sessions(one, root, "day 2", "u", "t", gap_minutes=5)


def test_failed_load_leaves_the_one_before(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "s")
    load_sessions(spark.createDataFrame([("a", at(1), 1)], SCHEMA), root, "day 1", "u", "t")
    before = key(carried_sessions(spark, root).collect())
    write = carried.write_table

    def fail(df, path, **options):
        if "/state/" in path:
            raise RuntimeError("lost")
        write(df, path, **options)

    monkeypatch.setattr(carried, "write_table", fail)
    late = spark.createDataFrame([("a", at(-90), 1)], SCHEMA)
    with pytest.raises(RuntimeError):
        load_sessions(late, root, "day 0", "u", "t")
    assert key(carried_sessions(spark, root).collect()) == before
    monkeypatch.undo()
    assert load_sessions(late, root, "day 0", "u", "t")
    assert [r.session_id for r in carried_sessions(spark, root).orderBy("session_start_at").collect()] == ["a-1", "a-2"]


def test_users_that_come_in_time_read_no_old_slots(spark, tmp_path):
    root = str(tmp_path / "s")
    for day in range(3):
        load_sessions(spark.createDataFrame([("a", at(1440 * day), 1)], SCHEMA), root, f"day {day}", "u", "t")
    slots = spark.read.parquet(f"{root}/slots")
    assert slots.groupBy("v").count().where(F.col("count") > 1).count() == 0
    assert spark.read.parquet(f"{root}/cuts").count() == 0
