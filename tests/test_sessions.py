"""Sessions: literal cases, brute force, and behaviour under skew."""

import datetime as dt
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.operators import sessions as module
from clickloom.operators.sessions import assign_sessions, session_table

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "anonymousId STRING, timestamp TIMESTAMP_NTZ"


def at(seconds):
    return None if seconds is None else T0 + dt.timedelta(seconds=seconds)


def frame(spark, rows):
    return spark.createDataFrame([(u, at(s)) for u, s in rows], SCHEMA)


def second(t):
    """Whole seconds since 1970, cut as ``unix_timestamp`` does."""
    return int((t - dt.datetime(1970, 1, 1)).total_seconds())


def brute_force(rows, gap_seconds):
    """Session rows and, per user, session number -> event times."""
    users = defaultdict(list)
    for user, seconds in rows:
        users[user].append(at(seconds))
    table, members = [], []
    for user, times in users.items():
        times = [t for t in times if t is None] + sorted(t for t in times if t is not None)
        starts, previous = [], None
        for t in times:
            if t is None or previous is None or second(t) - second(previous) > gap_seconds:
                starts.append(t)
            members.append((user, t, len(starts), starts[-1]))
            previous = t
        for i, start in enumerate(starts):
            table.append((None if user is None else f"{user}-{i + 1}", user, start,
                          starts[i + 1] if i + 1 < len(starts) else None))
    return Counter(table), Counter(members)


def check(spark, rows, gap_minutes=30):
    df = frame(spark, rows)
    table, members = brute_force(rows, gap_minutes * 60)
    assert Counter(tuple(r) for r in session_table(df, gap_minutes=gap_minutes).collect()) == table
    assigned = assign_sessions(df, gap_minutes=gap_minutes).select(
        "anonymousId", "timestamp", "session_number", "session_start_at")
    assert Counter(tuple(r) for r in assigned.collect()) == members


def test_exactly_the_gap_stays_one_second_more_starts(spark):
    check(spark, [("u", 0), ("u", 1800), ("u", 3601)])
    got = session_table(frame(spark, [("u", 0), ("u", 1800), ("u", 3601)])).orderBy("session_id").collect()
    assert [tuple(r) for r in got] == [
        ("u-1", "u", at(0), at(3601)), ("u-2", "u", at(3601), None)]


def test_each_event_without_time_is_a_session_numbered_first(spark):
    rows = [("n", None), ("n", 0), ("n", None)]
    got = session_table(frame(spark, rows)).orderBy("session_id").collect()
    assert [tuple(r) for r in got] == [
        ("n-1", "n", None, None), ("n-2", "n", None, at(0)), ("n-3", "n", at(0), None)]
    check(spark, rows)
    kept = session_table(frame(spark, rows), drop_null_ts=True).collect()
    assert [tuple(r) for r in kept] == [("n-1", "n", at(0), None)]
    assert assign_sessions(frame(spark, rows), drop_null_ts=True).count() == 1


def test_null_user_shares_one_timeline_without_session_id(spark):
    rows = [(None, 0), (None, 5000), (None, 5001), ("u", 1)]
    check(spark, rows)
    got = session_table(frame(spark, rows))
    assert got.filter("anonymousId IS NULL AND session_id IS NULL").count() == 2
    assert session_table(frame(spark, rows), drop_null_user=True).count() == 1


def test_fractions_are_floored_for_the_gap_but_kept_in_the_start(spark):
    check(spark, [("u", 0.1), ("u", 1800.9), ("u", 3600.999999), ("u", 5401.0)])
    assert session_table(frame(spark, [("u", 0.1), ("u", 1800.9)])).count() == 1


def test_times_before_1970_and_far_ahead(spark):
    check(spark, [("u", -1.8e9), ("u", -1.8e9 - 0.5), ("u", -1.8e9 + 1801), ("u", 2e9), ("u", 2e9 + 1800.5)])


def test_inactivity_before_each_session(spark):
    rows = [("u", 0), ("u", 600), ("u", 4200), ("u", None)]
    got = session_table(frame(spark, rows), keep_inactivity=True).orderBy("session_id").collect()
    assert [r.inactivity_time for r in got] == [None, None, 60.0]
    assert "inactivity_time" not in session_table(frame(spark, rows)).columns


def test_gap_of_zero_and_fractional_minutes(spark):
    rows = [("u", 0), ("u", 0.4), ("u", 1), ("u", 31), ("u", 62)]
    check(spark, rows, gap_minutes=0)
    check(spark, rows, gap_minutes=0.5)
    with pytest.raises(ValueError):
        session_table(frame(spark, rows), gap_minutes=-1)


def test_zoned_times_and_other_column_names(spark):
    df = frame(spark, [("u", 0), ("u", 4000)]).select(
        F.col("anonymousId").alias("who"), F.col("timestamp").cast("timestamp").alias("when"))
    assert session_table(df, "who", "when").count() == 2
    assert session_table(df, "who", "when").schema["session_start_at"].dataType.typeName() == "timestamp"


def test_invariants_on_all_events(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    sessions = session_table(events, "user_id", "ts", gap_minutes=120)
    open_ended = sessions.filter("next_session_start_at IS NULL").groupBy("user_id").count()
    users = events.select("user_id").distinct().count()
    assert open_ended.count() == users and open_ended.filter("count <> 1").isEmpty()
    assert sessions.filter("next_session_start_at <= session_start_at + INTERVAL 2 HOURS").isEmpty()
    assigned = assign_sessions(events, "user_id", "ts", gap_minutes=120)
    assert assigned.count() == events.count()
    assert assigned.select("session_id").distinct().count() == sessions.count()


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(
    st.sampled_from(["a", "b", "c", "d", "e", None]),
    st.one_of(st.none(), st.integers(-40, 40).map(lambda k: k * 450),
              st.floats(-9000, 9000).map(lambda x: round(x, 3)))), min_size=1, max_size=80),
    st.sampled_from([0, 1, 7.5, 30]))
def test_equals_brute_force(spark, rows, gap):
    check(spark, rows, gap)


def test_hot_user_copies_and_untimed_rows(spark):
    """One user holds most rows, most of these copies; another only rows without time."""
    hot = [("hot", s % 7200) for s in range(0, 60_000, 3)]
    copies = [("hot", 11)] * 20_000
    untimed = [("late", None)] * 20_000 + [("late", 5)]
    rest = [(f"u{i}", 60 * i) for i in range(300)]
    rows = hot + copies + untimed + rest
    df = frame(spark, rows).repartition(8)
    table, members = brute_force(rows, 1800)
    assert Counter(tuple(r) for r in session_table(df).collect()) == table
    got = assign_sessions(df).select("anonymousId", "timestamp", "session_number", "session_start_at")
    assert Counter(tuple(r) for r in got.collect()) == members


def test_what_reaches_the_user_window_is_bounded_by_time_not_by_rows(spark):
    df = frame(spark, [("hot", s) for s in range(0, 36_000, 2)] + [("hot", None)] * 500)
    slots, _ = module._slots_with_starts(df, "anonymousId", "timestamp", 1800)
    assert slots.count() == 36_000 / 1800 + 1


def test_untimed_rows_are_made_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(module, "_EXPAND_BLOCK", 10)
    df = spark.range(1000).select(
        F.lit("hot").alias("anonymousId"), F.lit(None).cast("timestamp_ntz").alias("timestamp"))
    sessions = session_table(df)
    numbers = sessions.select(F.split("session_id", "-")[1].cast("int").alias("n"),
                              F.spark_partition_id().alias("p")).collect()
    assert sorted(r.n for r in numbers) == list(range(1, 1001))
    assert len({r.p for r in numbers}) > 1
