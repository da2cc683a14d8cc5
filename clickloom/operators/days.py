"""Completeness of day series keyed by epoch-millisecond midnights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.report import with_text
from clickloom.operators.gaps import days_of_ranges, missing_ranges
from clickloom.schemas import DAY_MS


def next_day(day: Column) -> Column:
    """The day key after ``day``."""
    return day + F.lit(DAY_MS)


def missing_days(df: DataFrame, keys: Sequence[str] = (), day: str = "day_ms", *,
                 first: Column | int | None = None, last: Column | int | None = None) -> DataFrame:
    """Days between ``first`` and ``last`` on which a key has no row.

    The bounds default to the key's own first and last day; they may be aggregates
    over ``day`` or scalar subqueries, and the days are the midnights within them. A
    ``day`` that is no midnight is an error. The gaps are found as ranges first, see
    ``missing_ranges``, and dealt out in blocks. With given bounds a key without any
    day lacks them all.
    """
    return days_of_ranges(missing_ranges(df, keys, day, first=first, last=last), keys, day)


def day_status(present: DataFrame, day: str = "day_ms", *, first: Column | int | None = None,
               last: Column | int | None = None) -> DataFrame:
    """``day_ms, n_files, size_kb, status, line`` for every expected day.

    ``present`` has one row per day folder (see ``folder_volume``); expected days
    without a folder are added with no files and the status ``empty``.
    """
    absent = missing_days(present, day=day, first=first, last=last).select(
        day, F.lit(0).cast("bigint").alias("n_files"), F.lit(0.0).alias("size_kb"))
    every = present.select(day, "n_files", "size_kb").unionByName(absent)
    judged = every.withColumn(
        "status", F.when(F.col("n_files") == 0, "empty").otherwise("loaded"))
    return with_text(judged, "%d: %d files, %s KB, %s", [day, "n_files", "size_kb", "status"])
