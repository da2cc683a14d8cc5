"""Source-against-target contents: which keys are missing, extra or changed.

Each row is folded to a 64-bit hash of all its columns, and the hashes of a bucket of keys
are summed, the source's with a plus and the target's with a minus. A bucket whose sums are
all zero holds the same rows on both sides, in whatever order. Only the other buckets are
read again, as key and hash, to name the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.paths import quoted

BUCKETS = 1 << 16
MOST_BUCKETS = 1 << 20  # their numbers are sent to all tasks: 8 MB
_LOW = (1 << 32) - 1


def _ordered(column: Column, dtype: T.DataType) -> Column:
    """``column`` with the entries of every map in the order of their keys, as arrays."""
    if isinstance(dtype, T.StructType):
        fields = [_ordered(column.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(dtype.fields)]
        return F.when(column.isNotNull(), F.struct(*fields)) if fields else column
    if isinstance(dtype, T.ArrayType):
        return F.transform(column, lambda item: _ordered(item, dtype.elementType))
    if isinstance(dtype, T.MapType):
        entries = F.transform(F.map_entries(column), lambda entry: F.struct(
            F.to_json(F.struct(_ordered(entry["key"], dtype.keyType).alias("k"))).alias("k"),
            F.to_json(F.struct(_ordered(entry["value"], dtype.valueType).alias("v")),
                      {"ignoreNullFields": "false"}).alias("v")))
        return F.array_sort(entries)
    return column


def row_hash(df: DataFrame, columns: list[str]) -> Column:
    """A 64-bit hash of ``columns``. Nulls are told from absent neighbours at any depth; the
    order of a map's entries does not count."""
    parts = []
    for name in columns:
        column, dtype = F.col(quoted(name)), df.schema[name].dataType
        if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
            column = F.to_json(F.struct(_ordered(column, dtype).alias("c")), {"ignoreNullFields": "false"})
            parts.append(column)
        else:
            parts += [column, column.isNull()]
    return F.xxhash64(*parts)


def _signed(source: DataFrame, target: DataFrame, pk: str, buckets: int) -> DataFrame:
    """Rows of both sides as ``key, bucket, sign, high, low``."""
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"buckets must be 1 to {MOST_BUCKETS}")
    types = {f.name: f.dataType for f in source.schema.fields}
    if len(types) < len(source.columns) or len(set(target.columns)) < len(target.columns):
        raise ValueError("column names repeat")
    others = {f.name: f.dataType for f in target.schema.fields}
    # A written table has nullable columns throughout, so only the types are compared.
    unlike = sorted(n for n in types.keys() | others.keys()
                    if n not in types or n not in others
                    or types[n].simpleString() != others[n].simpleString())
    if unlike:
        raise ValueError(f"the tables differ in the columns {unlike}")
    columns = sorted(types)
    sides = []
    for df, sign in ((source, 1), (target, -1)):
        hashed = df.select(F.col(quoted(pk)).alias("key"), row_hash(df, columns).alias("hash"))
        sides.append(hashed.select(
            "key", F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"), F.lit(sign).alias("sign"),
            (F.shiftright("hash", 32) * sign).alias("high"),
            (F.col("hash").bitwiseAND(F.lit(_LOW)) * sign).alias("low")))
    return sides[0].unionByName(sides[1])


def _unequal() -> Column:
    return (F.sum("sign") != 0) | (F.sum("high") != 0) | (F.sum("low") != 0)


def differing_buckets(source: DataFrame, target: DataFrame, pk: str, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n_source, n_target)`` of the buckets whose rows differ.

    Rows are summed in the tasks that read them; at most ``buckets`` rows a task are shuffled.
    """
    return _differing(_signed(source, target, pk, buckets))


def _differing(signed: DataFrame) -> DataFrame:
    return (signed.groupBy("bucket").agg(
        F.count_if(F.col("sign") > 0).alias("n_source"), F.count_if(F.col("sign") < 0).alias("n_target"),
        _unequal().alias("unequal")).where("unequal").drop("unequal"))


def compare_contents(source: DataFrame, target: DataFrame, pk: str, buckets: int = BUCKETS) -> DataFrame:
    """``(key, status, n_source, n_target)`` of every key whose rows differ.

    ``status`` is ``missing`` (not in the target), ``extra`` (not in the source) or
    ``changed`` (rows or their number differ). Null is a key like any other; a repeated key
    is compared as a bag of rows, so order never counts. Both tables need the same columns
    and types, in any order; otherwise a ``ValueError`` names them. Equal or empty tables
    give no row.

    Both sides are scanned twice. The first pass shuffles sums of buckets only; the second
    keeps rows of differing buckets, whose numbers go to the tasks (at most ``buckets`` of 8
    bytes), and combines them by key before the shuffle, so a hot key costs one row a task.
    More buckets leave fewer equal keys in the second pass.
    """
    signed = _signed(source, target, pk, buckets)
    suspects = signed.join(F.broadcast(_differing(signed).select("bucket")), "bucket", "left_semi")
    keys = suspects.groupBy("key").agg(
        F.count_if(F.col("sign") > 0).alias("n_source"), F.count_if(F.col("sign") < 0).alias("n_target"),
        _unequal().alias("unequal")).where("unequal")
    status = F.when(F.col("n_target") == 0, "missing").when(F.col("n_source") == 0, "extra").otherwise("changed")
    return keys.select("key", status.alias("status"), "n_source", "n_target")
