"""Nested records as tables: one row each in a root table, child rows for arrays and maps.

Narrow projections only: no shuffle. Each table reads just its own part of the records.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.paths import leaf_paths, quoted

_ITEM = "item"


def _field(names: tuple[str, ...]) -> Column:
    return F.col(".".join([_ITEM, *map(quoted, names)]))


def _leaves(dtype: T.DataType) -> list[tuple[tuple[str, ...], T.DataType]]:
    return leaf_paths(dtype) if isinstance(dtype, T.StructType) else [((), dtype)]


def child_tables(df: DataFrame, key: str, sep: str = "_", *, key_name: str = "row_key",
                 at_name: str = "at") -> dict[str, DataFrame]:
    """All tables of ``df``: ``""`` is the root, ``a.b[]`` has a row for each element of the
    array ``a.b``, ``c{}`` one for each entry of the map ``c``, ``a.b[].d[]`` one for each
    element of ``d`` in the elements of ``a.b``, and so on to any depth.

    Every row has the ``key`` of its record as ``key_name`` and its positions from the
    record down as ``at_name``, an array that is empty in the root; a row's parent has the
    same key and all positions but the last. Struct fields are columns named by their joined
    path, an element that is no struct is ``value``, a map's entry has ``key`` and ``value``.
    An array or map is represented by ``<path>_size``, null where it is null, so nothing
    told by the record is lost but the difference between a null struct and one of nulls.
    Entries of a map are numbered in the order the map holds them.

    Null elements have rows of nulls. A null key is kept; repeated keys repeat their rows.
    Names that would clash are an error: choose another ``sep``, ``key_name`` or ``at_name``.
    """
    record = F.struct(*[F.col(quoted(name)) for name in df.columns])
    root = df.select(F.col(quoted(key)).alias("key"), F.array().cast("array<int>").alias("at"),
                     record.alias(_ITEM))
    tables: dict[str, DataFrame] = {}
    pending = [("", root, df.schema)]
    while pending:
        name, frame, dtype = pending.pop(0)
        columns = {}
        for names, leaf in _leaves(dtype):
            path = ".".join(names)
            here = f"{name}.{path}" if name and path else name or path
            if isinstance(leaf, T.ArrayType):
                pending.append((f"{here}[]", _elements(frame, names), leaf.elementType))
            elif isinstance(leaf, T.MapType):
                entry = T.StructType([T.StructField("key", leaf.keyType), T.StructField("value", leaf.valueType)])
                pending.append((f"{here}{{}}", _entries(frame, names), entry))
            else:
                columns[names or ("value",)] = _field(names)
                continue
            size = F.when(_field(names).isNotNull(), F.size(_field(names)))
            columns[(*names, "size")] = size
        labels = [key_name, at_name, *(sep.join(names) for names in columns)]
        clashing = sorted(n for n, c in Counter(label.lower() for label in labels).items() if c > 1)
        if clashing:
            raise ValueError(f"names of the table {name!r} repeat: {clashing}")
        tables[name] = frame.select(
            F.col("key").alias(key_name), F.col("at").alias(at_name),
            *[column.alias(sep.join(names)) for names, column in columns.items()])
    return tables


def _elements(frame: DataFrame, names: tuple[str, ...]) -> DataFrame:
    spread = frame.select("key", "at", F.posexplode(_field(names)).alias("position", "element"))
    return spread.select("key", _deeper(), F.col("element").alias(_ITEM))


def _entries(frame: DataFrame, names: tuple[str, ...]) -> DataFrame:
    spread = frame.select("key", "at", F.posexplode(_field(names)).alias("position", "entry_key", "entry_value"))
    return spread.select("key", _deeper(), F.struct(
        F.col("entry_key").alias("key"), F.col("entry_value").alias("value")).alias(_ITEM))


def _deeper() -> Column:
    return F.concat("at", F.array("position")).alias("at")
