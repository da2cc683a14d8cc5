"""Largest readings, with "no reading" sentinels left out."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.paths import quoted, resolve
from clickloom.functions.report import with_text
from clickloom.schemas import READING_KEYS, READING_SENTINELS, READING_STATS


def is_reading(df: DataFrame, column: str, sentinels: Iterable[float] = READING_SENTINELS) -> Column:
    """True where ``column`` holds a value: not null, not NaN and no sentinel."""
    value = F.col(quoted(column))
    valid = value.isNotNull() & ~value.isin(*sentinels)
    found = resolve(df.schema, column)
    if found and isinstance(found.dtype, (T.DoubleType, T.FloatType)):
        valid = valid & ~F.isnan(value)
    return valid


def largest(df: DataFrame, column: str, keys: Sequence[str] = READING_KEYS,
            sentinels: Iterable[float] = READING_SENTINELS, n: int = 1) -> DataFrame:
    """The ``n`` rows with the largest ``column``; ties go to the larger keys, in order."""
    return (df.filter(is_reading(df, column, sentinels))
            .select(*[F.col(quoted(k)) for k in (*keys, column)])
            .orderBy(*[F.desc(quoted(c)) for c in (column, *keys)])
            .limit(n))


def extremes_report(df: DataFrame, stats: Sequence[tuple[str, str, str]] = READING_STATS,
                    keys: Sequence[str] = READING_KEYS,
                    sentinels: Iterable[float] = READING_SENTINELS,
                    overrides: Mapping[str, Iterable[float]] | None = None) -> DataFrame:
    """The row of the maximum for each ``(description, column, unit)`` of ``stats``.

    All maxima come from one pass: a struct compares field by field, so the greatest
    ``(value, *keys)`` is the maximum together with its row. ``overrides`` replaces
    the sentinels for single columns. A column without any reading gives nulls. Rows are
    compared by the column as it is; only the shown value has the type common to all.
    """
    sentinels = tuple(sentinels)
    picked = []
    for place, (_, column, _) in enumerate(stats):
        valid = is_reading(df, column, (overrides or {}).get(column, sentinels))
        row = F.struct(F.col(quoted(column)).alias("value"), *[F.col(quoted(k)) for k in keys])
        picked.append(F.max(F.when(valid, row)).alias(f"_top_{place}"))
    kinds = {df.schema[column].dataType.simpleString() for _, column, _ in stats if column in df.columns}
    shown = kinds.pop() if len(kinds) == 1 else "double"
    rows = F.array(*[
        F.struct(F.lit(description).alias("description"), F.lit(column).alias("column_name"),
                 *[F.col(f"_top_{place}.{quoted(k)}").alias(k) for k in keys],
                 F.col(f"_top_{place}.value").cast(shown).alias("value"), F.lit(unit).alias("units"))
        for place, (description, column, unit) in enumerate(stats)])
    return df.agg(*picked).select(F.inline(rows))


def reading_lines(report: DataFrame) -> DataFrame:
    """The text lines of an :func:`extremes_report` over weather readings."""
    return with_text(report, "%s: %s%s on %s at %s (%s, %s)", [
        "description", "value", "units", "DATE", "NAME", "LATITUDE", "LONGITUDE"])
