"""Flattening of nested records. Narrow projections only: no shuffle."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.calendar import with_calendar
from clickloom.functions.paths import leaf_paths, quoted, safe_col
from clickloom.schemas import EVENT_COLUMNS, EVENT_SQL_COLUMNS, LOCAL_ZONE


def project(df: DataFrame, columns: Iterable[tuple[str, str]]) -> DataFrame:
    """Select ``(alias, path)`` pairs; a path the schema lacks gives a text null."""
    return df.select(*[safe_col(df.schema, path).alias(alias) for alias, path in columns])


def flatten_event(events: DataFrame, zone: str = LOCAL_ZONE, *, basis: str = "raw",
                  iso: bool = False, week_key: str = "sunday", keep: Iterable[str] = ()) -> DataFrame:
    """Nested events with calendar keys as the 28 flat columns of ``EVENT_COLUMNS``, and the
    columns of ``keep`` as they are."""
    dated = with_calendar(events, "timestamp", zone, basis=basis, iso=iso, week_key=week_key)
    return project(dated, [*EVENT_COLUMNS, *((name, name) for name in keep)])


def add_safe_columns(df: DataFrame, columns: Mapping[str, str | tuple[str, str]]) -> DataFrame:
    """Add ``{name: path}`` or ``{name: (path, type)}``.

    With a type the column always has it; without, an absent path gives a text null.
    """
    added = {}
    for name, spec in columns.items():
        path, dtype = (spec, None) if isinstance(spec, str) else spec
        added[name] = safe_col(df.schema, path, dtype)
    return df.withColumns(added)


def flatten(df: DataFrame, sep: str = "_", drop: Iterable[str] = ()) -> DataFrame:
    """Every leaf of ``df`` as a top-level column named by its joined path.

    ``drop`` names top-level fields to leave out; names ``df`` lacks are ignored.
    """
    left_out = {name.lower() for name in drop}
    leaves = [names for names, _ in leaf_paths(df.schema) if names[0].lower() not in left_out]
    repeated = [n for n, c in Counter(sep.join(x).lower() for x in leaves).items() if c > 1]
    if repeated:
        raise ValueError(f"flattened names repeat: {sorted(repeated)}; choose another sep")
    return df.select(*[
        F.col(".".join(map(quoted, names))).alias(sep.join(names)) for names in leaves])


def event_view(events: DataFrame, name: str = "events_nested") -> str:
    """Register ``events`` for SQL and return the nested projection over that view.

    The text has no LIMIT: the caller adds the filter, order and limit wanted.
    """
    events.createOrReplaceTempView(name)
    columns = ", ".join(
        f"{'.'.join(map(quoted, path.split('.')))} AS {quoted(alias)}"
        for alias, path in EVENT_SQL_COLUMNS)
    return f"SELECT {columns} FROM {quoted(name)}"
