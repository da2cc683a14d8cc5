"""Sessions over an unbounded stream, across day boundaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.calendar import instant_of, utc_clock_of
from clickloom.functions.paths import quoted


def stream_sessions(events: DataFrame, user: str, ts: str, gap_minutes: int = 30,
                    delay: str = "1 hour") -> DataFrame:
    """``<user>, session_start_at, last_event_at, n_events`` per closed session, in UTC clock.

    ``events`` is a stream; for a table use :func:`session_table`. A session is emitted
    once the watermark (newest event minus ``delay``) has passed its end, so the newest
    session stays open until later events arrive. Events without a time belong to no
    window. The gap is exact here, not floored to whole seconds. Events older than the
    watermark are left out by Spark; :func:`write_available` counts them.
    """
    # Watermarks need a zoned timestamp.
    zoned = events.select(
        F.col(quoted(user)), instant_of(events, ts).alias("_moment"))
    moment = F.col("_moment")
    grouped = zoned.withWatermark("_moment", delay).groupBy(
        F.col(quoted(user)), F.session_window(moment, f"{gap_minutes} minutes").alias("_session"))
    sessions = grouped.agg(F.min(moment).alias("_first"), F.max(moment).alias("_last"),
                           F.count(F.lit(1)).alias("n_events"))
    return sessions.select(
        F.col(quoted(user)), utc_clock_of(sessions, "_first").alias("session_start_at"),
        utc_clock_of(sessions, "_last").alias("last_event_at"), "n_events")


class LateRows(ValueError):
    """Rows came later than the watermark allows and are not in the target."""


def write_available(stream: DataFrame, target: str, checkpoint: str, *, allow_late: bool = False) -> int:
    """Append what a stream has ready to a Parquet table; returns the late rows left out.

    Spark drops rows behind the watermark without an error. They are counted over all
    batches of the run, and :class:`LateRows` is raised unless ``allow_late`` is set.
    Partial sessions merged before the shuffle count as one row each.
    """
    late: dict[int, int] = {}

    def note(progress: list[dict]) -> None:
        for batch in progress:
            late[batch["batchId"]] = sum(
                state["numRowsDroppedByWatermark"] for state in batch["stateOperators"])

    query = (stream.writeStream.format("parquet").outputMode("append").option("path", target)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    # Spark keeps the latest progress reports only, so they are read along the way.
    while not query.awaitTermination(5):
        note(query.recentProgress)
    note(query.recentProgress)
    dropped = sum(late.values())
    if dropped and not allow_late:
        raise LateRows(f"{dropped} rows were behind the watermark; raise the delay or allow them")
    return dropped
