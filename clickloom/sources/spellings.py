"""JSON logs whose keys come in several spellings.

One pass finds the schema: every task folds its lines to one variant schema, and these are
merged. Fields whose names differ in case only are one field, known by all its spellings; a
second pass reads each of them wherever it stands. A value that does not fit its field is
not lost: the line's text is kept in ``_corrupt_record``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.schemas import CORRUPT

# A name in a variant schema that is no plain identifier stands in backticks.
_OBJECT = re.compile(r"(`(?:[^`]|``)*`)|\bOBJECT<")

Spelled = list[tuple[tuple[str, ...], T.DataType]]


def _lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path).where(F.trim("value") != "").select(
        "value", F.try_parse_json("value").alias("_v"))


@contextmanager
def _case_sensitive(spark: SparkSession) -> Iterator[None]:
    """Else the merge of two schemas keeps one spelling of a name and drops the others."""
    setting = "spark.sql.caseSensitive"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def infer_spellings(spark: SparkSession, path) -> T.StructType:
    """All fields of a JSON log in all their spellings; one aggregation over the lines.

    Fields of conflicting types are variants. Lines that are no objects have no fields.
    """
    with _case_sensitive(spark):
        found = (_lines(spark, path).where(F.schema_of_variant("_v").startswith("OBJECT"))
                 .agg(F.schema_of_variant_agg("_v")).head()[0])
    if found in (None, "VOID", "OBJECT<>"):
        return T.StructType()
    ddl = _OBJECT.sub(lambda m: m[1] or "STRUCT<", found)
    return T.StructType.fromDDL(f"root {ddl}")["root"].dataType


def _fields(spelled: Spelled) -> dict[str, Spelled]:
    """The fields of some objects by lower-cased name, each with all its places."""
    found: dict[str, Spelled] = {}
    for place, dtype in spelled:
        if isinstance(dtype, T.StructType):
            for field in dtype.fields:
                found.setdefault(field.name.lower(), []).append(((*place, field.name), field.dataType))
    return found


def folded(spellings: T.StructType) -> T.StructType:
    """One field for all spellings of a name, in the order in which they sort first.

    The first spelling gives the name. Fields of one type keep it, an object in one spelling
    and no object in another is a variant, other conflicts are text.
    """
    def fold(spelled: Spelled) -> T.DataType:
        kinds = [dtype for _, dtype in spelled if not isinstance(dtype, T.NullType)]
        if any(isinstance(k, T.StructType) for k in kinds):
            if not all(isinstance(k, T.StructType) for k in kinds):
                return T.VariantType()
            return T.StructType([T.StructField(min(places, key=lambda p: p[0][-1])[0][-1], fold(places))
                                 for _, places in sorted(_fields(spelled).items())])
        if not kinds:
            return T.StringType()
        if len(set(kinds)) > 1:
            return T.StringType()
        return T.VariantType() if "struct" in kinds[0].simpleString() else kinds[0]

    folded_type = fold([((), spellings)])
    return folded_type if isinstance(folded_type, T.StructType) else T.StructType()


def _place(names: tuple[str, ...]) -> str:
    return "$" + "".join(f'["{n}"]' if "'" in n else f"['{n}']" for n in names)


def read_spelled(spark: SparkSession, path, spellings: T.StructType | None = None,
                 schema: T.StructType | None = None) -> DataFrame:
    """A JSON log with the fields of ``schema``, whatever their spelling, and ``_corrupt_record``.

    ``spellings`` comes from :func:`infer_spellings` (by default found here, in a pass of its
    own); ``schema`` defaults to :func:`folded`. In a line with two spellings of a key the one
    spelled as in ``schema`` wins, then the first in order; a key repeated in one spelling has
    its last value. A line that is no object, or that has a value which does not fit its field,
    has its text in ``_corrupt_record``; what fits is read.
    """
    spellings = infer_spellings(spark, path) if spellings is None else spellings
    schema = schema or folded(spellings)
    misfits: list[Column] = []

    def present(places: Spelled) -> Column:
        found = F.coalesce(*[F.try_variant_get("_v", _place(names), "variant") for names, _ in places])
        return found.isNotNull() & ~F.is_variant_null(found)

    def build(struct: T.StructType, spelled: Spelled) -> list[Column]:
        fields, columns = _fields(spelled), []
        for field in struct.fields:
            places = sorted(fields.get(field.name.lower(), []), key=lambda p: (p[0][-1] != field.name, p[0]))
            if isinstance(field.dataType, T.StructType):
                # what is an object in some lines only has no known fields: they are looked for as in the schema
                loose = [(p, T.StructType([T.StructField(n, T.StringType()) for c in field.dataType.names for n in dict.fromkeys((c, c.lower()))]))
                         for p, dtype in places if isinstance(dtype, T.VariantType)]
                parts = build(field.dataType, [p for p in places if isinstance(p[1], T.StructType)] + loose)
                odd = [p for p in places if not isinstance(p[1], T.StructType)]
                if odd:  # an object in some lines, something else in others: only its fields are read
                    found = F.coalesce(*[F.try_variant_get("_v", _place(n), "variant") for n, _ in odd])
                    misfits.append(found.isNotNull() & ~F.is_variant_null(found) & ~F.schema_of_variant(found).startswith("OBJECT"))
                some = reduce(or_, [part.isNotNull() for part in parts])
                columns.append(F.when(some, F.struct(*parts)).alias(field.name))
            elif places:
                value = F.coalesce(*[F.try_variant_get("_v", _place(names), field.dataType.simpleString()) for names, _ in places])
                misfits.append(present(places) & value.isNull())
                columns.append(value.alias(field.name))
            else:
                columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        return columns

    columns = build(schema, [((), spellings)])
    unread = ~F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False))
    corrupt = F.when(reduce(or_, misfits, unread), F.col("value")).alias(CORRUPT)
    return _lines(spark, path).select(*columns, corrupt)
