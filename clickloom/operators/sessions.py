"""Sessions by inactivity gap.

A session ends when the next event of the same user comes more than ``gap`` later,
in whole seconds. The operators never sort raw events by user. They first fold the
events of a user that fall into the same time slot, where a slot is as long as the
gap: two events of one slot are at most a gap apart, so a session can only begin at
the first event of a slot. (first, last, count) per slot is therefore enough for an
exact answer, it is combined before the shuffle, and a user has at most
``time range / gap`` slots, however many events or copies of events they have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.paths import quoted
from clickloom.operators.numbering import number_rows
from clickloom.schemas import SESSION_GAP_MINUTES

_EXPAND_BLOCK = 65_536


def slot_of(ts: Column, gap_seconds: int) -> Column:
    """First second of the slot that ``ts`` falls into."""
    second = F.unix_timestamp(ts)
    return second - F.pmod(second, F.lit(max(gap_seconds, 1)))


def gap_in_seconds(gap_minutes: float) -> int:
    if gap_minutes < 0:
        raise ValueError("the gap must not be negative")
    return int(gap_minutes * 60)


def _kept(df: DataFrame, user: str, ts: str, drop_null_ts: bool, drop_null_user: bool) -> DataFrame:
    if drop_null_ts:
        df = df.filter(F.col(quoted(ts)).isNotNull())
    if drop_null_user:
        df = df.filter(F.col(quoted(user)).isNotNull())
    return df


def _slots_with_starts(df: DataFrame, user: str, ts: str, gap: int) -> tuple[DataFrame, Window]:
    """One row per (user, slot) with ``_start``: does a session begin in the slot?

    Events without a time share the slot ``null``, which sorts first.
    """
    moment = F.col(quoted(ts))
    slots = df.groupBy(F.col(quoted(user)).alias("_user"), slot_of(moment, gap).alias("_slot")).agg(
        F.min(moment).alias("_first"), F.max(moment).alias("_last"),
        F.count(F.lit(1)).alias("_rows"))
    timeline = Window.partitionBy("_user").orderBy("_slot")
    idle = F.unix_timestamp("_first") - F.lag(F.unix_timestamp("_last")).over(timeline)
    marked = slots.withColumn("_idle", idle).withColumn(
        "_start", F.coalesce(F.col("_idle") > gap, F.lit(True)))
    return marked, timeline


def session_table(df: DataFrame, user: str = "anonymousId", ts: str = "timestamp",
                  gap_minutes: float = SESSION_GAP_MINUTES, *, drop_null_ts: bool = False,
                  drop_null_user: bool = False, keep_inactivity: bool = False) -> DataFrame:
    """One row per session: ``session_id, <user>, session_start_at, next_session_start_at``.

    ``session_id`` is ``<user>-<n>``, null for a null user. Every event without a time
    is a session of its own and numbered first; ``drop_null_ts`` leaves these out.
    ``keep_inactivity`` adds ``inactivity_time``, the minutes without an event before
    the session, null for a user's first.
    """
    kept = _kept(df, user, ts, drop_null_ts, drop_null_user)
    slots, timeline = _slots_with_starts(kept, user, ts, gap_in_seconds(gap_minutes))
    so_far = timeline.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    untimed = F.col("_slot").isNull()
    sessions = slots.filter("_start").select(
        "_user", "_slot", "_rows", (F.col("_idle") / 60).alias("inactivity_time"),
        F.col("_first").alias("session_start_at"),
        F.sum(F.when(untimed, F.col("_rows")).otherwise(1)).over(so_far).alias("_number"),
        F.lead("_first").over(timeline).alias("next_session_start_at"))
    timed = sessions.filter(~untimed)
    if not drop_null_ts:
        timed = timed.unionByName(one_session_per_row(sessions.filter(untimed)))
    result = timed.select(
        F.concat(F.col("_user").cast("string"), F.lit("-"), F.col("_number").cast("string"))
        .alias("session_id"),
        F.col("_user").alias(user), "session_start_at", "next_session_start_at",
        "inactivity_time")
    return result if keep_inactivity else result.drop("inactivity_time")


def one_session_per_row(counted: DataFrame) -> DataFrame:
    """Turn a row standing for ``_rows`` untimed events into that many sessions.

    The rows are made block by block after spreading the blocks over all tasks, so
    one user holding a large share of the table does not fill a single task.
    """
    spark = counted.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = counted.withColumn("_block", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.expr(f"(_rows - 1) div {_EXPAND_BLOCK}")))
    ).repartition(tasks, "_user", "_block")
    first = F.col("_block") * _EXPAND_BLOCK + 1
    numbered = blocks.withColumn("_number", F.explode(F.sequence(
        first, F.least(first + (_EXPAND_BLOCK - 1), F.col("_rows")))))
    return numbered.withColumn(
        "next_session_start_at",
        F.when(F.col("_number") == F.col("_rows"), F.col("next_session_start_at"))
        .otherwise(F.col("session_start_at"))).drop("_block")


def assign_sessions(df: DataFrame, user: str = "anonymousId", ts: str = "timestamp",
                    gap_minutes: float = SESSION_GAP_MINUTES, *, drop_null_ts: bool = False,
                    drop_null_user: bool = False) -> DataFrame:
    """Every event with ``session_id, session_number, session_start_at`` added.

    All events of a slot belong to one session, so the sessions are computed on slots
    and joined back by equality on (user, slot). The slot side has one row per key,
    which lets adaptive execution split a hot key of the event side. Events without a
    time are numbered apart, see :func:`number_rows`; that runs one job when called.
    """
    kept = _kept(df, user, ts, drop_null_ts, drop_null_user)
    gap = gap_in_seconds(gap_minutes)
    slots, timeline = _slots_with_starts(kept, user, ts, gap)
    so_far = timeline.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sessions = slots.select(
        "_user", F.col("_slot").alias("_slot_key"),
        F.sum(F.when(F.col("_slot").isNull(), F.col("_rows")).when(F.col("_start"), 1)
              .otherwise(0)).over(so_far).alias("session_number"),
        F.last(F.when(F.col("_start"), F.col("_first")), ignorenulls=True).over(so_far)
        .alias("session_start_at"))
    moment = F.col(quoted(ts))
    same = F.col(quoted(user)).eqNullSafe(F.col("_user")) & (F.col("_slot") == F.col("_slot_key"))
    assigned = (kept.filter(moment.isNotNull()).withColumn("_slot", slot_of(moment, gap))
                .join(sessions.filter(F.col("_slot_key").isNotNull()), same)
                .drop("_user", "_slot", "_slot_key"))
    if not drop_null_ts:
        untimed = number_rows(kept.filter(moment.isNull()), [user], "session_number")
        assigned = assigned.unionByName(untimed.withColumn("session_start_at", moment))
    return assigned.withColumn("session_id", F.concat(
        F.col(quoted(user)).cast("string"), F.lit("-"), F.col("session_number").cast("string")))
