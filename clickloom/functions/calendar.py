"""Time-zone shift, calendar keys and epoch-millisecond day keys.

Times are carried as zone-less ``TIMESTAMP_NTZ`` wall clocks, so no result depends
on the session time zone.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.paths import quoted, resolve
from clickloom.schemas import DAY_MS, LOCAL_ZONE, TIME_COLUMNS

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def instant(column: Column, dtype: T.DataType, source_zone: str = "UTC") -> Column:
    """``column`` as zoned timestamp; text that is no time becomes null.

    Zone-less times and dates are clock times of ``source_zone``.
    """
    if isinstance(dtype, T.TimestampType):
        return column
    if isinstance(dtype, T.StringType):
        return column.try_cast("timestamp")
    if isinstance(dtype, T.TimestampNTZType):
        as_utc = F.timestamp_micros(_micros(column))
    elif isinstance(dtype, T.DateType):
        as_utc = F.timestamp_seconds(F.unix_date(column).cast("bigint") * 86_400)
    else:
        raise TypeError(f"not a time column: {dtype.simpleString()}")
    return as_utc if source_zone == "UTC" else F.to_utc_timestamp(as_utc, source_zone)


def _micros(clock: Column) -> Column:
    """Microseconds of a zone-less time since 1970, without a detour over the session zone."""
    fraction = (F.extract(F.lit("SECOND"), clock) * 1_000_000).cast("bigint") % 1_000_000
    # unix_timestamp cuts towards 1970, so earlier times with a fraction are one too late.
    second = F.unix_timestamp(clock) - F.when(
        (clock < F.expr(_EPOCH)) & (fraction > 0), 1).otherwise(0)
    return second * 1_000_000 + fraction


def instant_of(df: DataFrame, name: str, source_zone: str = "UTC") -> Column:
    """:func:`instant` of a column of ``df``."""
    found = resolve(df.schema, name)
    if found is None:
        raise ValueError(f"no column {name!r}")
    return instant(found.column(), found.dtype, source_zone)


def wall_clock(moment: Column, zone: str = "UTC") -> Column:
    """A zoned timestamp as the zone-less clock time of ``zone``.

    A plain cast would take the session zone, and ``convert_timezone`` looks both
    zones up again for every row.
    """
    shifted = moment if zone == "UTC" else F.from_utc_timestamp(moment, zone)
    return F.timestamp_add("MICROSECOND", F.unix_micros(shifted), F.expr(_EPOCH))


def utc_clock_of(df: DataFrame, name: str) -> Column:
    """A column of ``df`` as UTC clock time."""
    found = resolve(df.schema, name)
    if found and isinstance(found.dtype, T.TimestampNTZType):
        return found.column()
    return wall_clock(instant_of(df, name))


def week_start_sunday(day: Column) -> Column:
    """The Sunday on or before the day preceding ``day``: Monday of its week minus one."""
    return F.date_sub(F.trunc(day, "week"), 1)


def year_week(day: Column, iso: bool = False) -> Column:
    """``year-week``. Plain: calendar year and unpadded ISO week, so the days around
    New Year may pair a week with the other year. ``iso``: week year, two-digit week.
    """
    week = F.weekofyear(day).cast("string")
    if iso:
        year = F.extract(F.lit("YEAROFWEEK"), day)
        return F.concat(year.cast("string"), F.lit("-"), F.lpad(week, 2, "0"))
    return F.concat(F.year(day).cast("string"), F.lit("-"), week)


def with_calendar(df: DataFrame, ts: str = "timestamp", zone: str = LOCAL_ZONE, *,
                  source_zone: str = "UTC", basis: str = "raw", iso: bool = False,
                  week_key: str = "sunday") -> DataFrame:
    """Add ``local_timestamp, next_local_day, ywd, yw, ym, ymd`` derived from ``ts``.

    ``source_zone`` is the zone of times that carry none. ``basis``: ``raw`` formats
    ``ym``/``ymd`` from the time as given (in UTC if it has a zone), ``local`` from the
    local one. ``week_key``: ``sunday`` is the Sunday opening the local week,
    ``yesterday`` the local day before.
    """
    if basis not in ("raw", "local"):
        raise ValueError("basis is 'raw' or 'local'")
    if week_key not in ("sunday", "yesterday"):
        raise ValueError("week_key is 'sunday' or 'yesterday'")
    clocks = df.withColumns({
        "_utc": utc_clock_of(df, ts), "local_timestamp": wall_clock(instant_of(df, ts, source_zone), zone)})
    next_day = F.date_add(F.col("local_timestamp"), 1)
    ymd = F.col("_utc" if basis == "raw" else "local_timestamp").cast("date").cast("string")
    return clocks.withColumns({
        "next_local_day": next_day,
        "ywd": week_start_sunday(next_day) if week_key == "sunday"
        else F.date_sub(F.col("local_timestamp"), 1),
        "yw": year_week(next_day, iso),
        "ym": F.substring(ymd, F.lit(1), F.length(ymd) - 3),
        "ymd": ymd,
    }).drop("_utc")


def day_ms(df: DataFrame, ts: str) -> Column:
    """UTC midnight of ``ts`` in epoch milliseconds."""
    day = utc_clock_of(df, ts).cast("date")
    return F.unix_date(day).cast("bigint") * F.lit(DAY_MS)


def cast_columns(df: DataFrame, names: Iterable[str] = TIME_COLUMNS,
                 dtype: str = "timestamp") -> DataFrame:
    """``try_cast`` the columns among ``names`` that ``df`` has; skip the others."""
    wanted = {name.lower() for name in names}
    return df.withColumns({
        name: F.col(quoted(name)).try_cast(dtype)
        for name in df.columns if name.lower() in wanted
    })
