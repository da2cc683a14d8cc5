"""Missing days as ranges: one row for each gap, however long it is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.paths import quoted
from clickloom.schemas import DAY_MS

_BLOCK_DAYS = 4096


def midnights(df: DataFrame, day: str) -> DataFrame:
    """``df`` with ``day`` checked: a value that is no midnight is an error."""
    column = F.col(quoted(day))
    return df.withColumn(day, F.when(column % DAY_MS == 0, column).when(
        column.isNotNull(), F.raise_error(
            F.concat(F.lit("no midnight: "), column.cast("string"))).cast("bigint")))


def missing_ranges(df: DataFrame, keys: Sequence[str] = (), day: str = "day_ms", *,
                   first: Column | int | None = None, last: Column | int | None = None) -> DataFrame:
    """``keys, first_missing, last_missing, n_days``: the runs of days between ``first`` and
    ``last`` on which a key has no row.

    Bounds are as in ``missing_days``. Rows are reduced to distinct (key, day) first; then each
    day meets the one before it, with the days just outside the bounds as outermost ones. No
    list or sequence is made, so a stray day far away costs one row.
    """
    column = F.col(quoted(day))
    present = midnights(df, day).select(*keys, column.cast("bigint").alias("_day")).distinct()
    # bounds given as aggregates speak of the day column by its name
    named = present.withColumnRenamed("_day", day)
    low, high = (bound if isinstance(bound, Column) else F.lit(bound).cast("bigint")
                 for bound in (F.min(column) if first is None else first, F.max(column) if last is None else last))
    bounds = named.groupBy(*keys).agg(
        (F.ceil(low / DAY_MS).cast("bigint") * DAY_MS).alias("_first"),
        (F.floor(high / DAY_MS).cast("bigint") * DAY_MS).alias("_last")).where("_first <= _last")
    edges = bounds.withColumn("_day", F.explode(F.array(F.col("_first") - DAY_MS, F.col("_last") + DAY_MS)))
    nothing = F.lit(None).cast("bigint")
    days = present.where("_day IS NOT NULL").select("*", nothing.alias("_first"), nothing.alias("_last")).unionByName(edges)
    of_key = Window.partitionBy(*keys)
    steps = days.select(
        *keys, "_day", F.lag("_day").over(of_key.orderBy("_day")).alias("_before"),
        F.max("_first").over(of_key).alias("_low"), F.max("_last").over(of_key).alias("_high"))
    ranges = steps.where("_before IS NOT NULL AND _low IS NOT NULL").select(
        *keys, F.greatest(F.col("_before") + DAY_MS, "_low").alias("first_missing"),
        F.least(F.col("_day") - DAY_MS, "_high").alias("last_missing"))
    return ranges.where("first_missing <= last_missing").withColumn(
        "n_days", F.expr(f"(last_missing - first_missing) div {DAY_MS} + 1"))


def days_of_ranges(ranges: DataFrame, keys: Sequence[str] = (), day: str = "day_ms") -> DataFrame:
    """One row for each day of :func:`missing_ranges`, made in blocks of bounded size."""
    length = _BLOCK_DAYS * DAY_MS
    blocks = ranges.withColumn("_from", F.explode(F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n_days - 1) div {_BLOCK_DAYS}")),
        lambda block: F.col("first_missing") + block * length)))
    return blocks.select(*keys, F.explode(F.sequence(
        F.col("_from"), F.least(F.col("last_missing"), F.col("_from") + (length - DAY_MS)),
        F.lit(DAY_MS).cast("bigint"))).alias(day))
