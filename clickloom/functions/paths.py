"""Nested column paths: resolve, read safely, enumerate leaves.

All decisions are taken from the schema, so a missing path never raises and no
exception has to be caught.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_POSITION = re.compile(r"^(.*)\[(\d+)\]$")


@dataclass(frozen=True)
class Resolved:
    """A path found in a schema: field names as spelled there and the type at the end."""

    names: tuple[str, ...]
    position: int | None
    dtype: T.DataType

    def column(self) -> Column:
        found = F.col(".".join(quoted(name) for name in self.names))
        return found if self.position is None else F.get(found, F.lit(self.position))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def resolve(schema: T.StructType, path: str) -> Resolved | None:
    """Look ``a.b.c`` or ``a.b[0]`` up in ``schema``; ``None`` if it is not there.

    An exactly spelled field wins; otherwise the lookup ignores case.
    """
    match = _POSITION.match(path)
    position = int(match.group(2)) if match else None
    dtype: T.DataType = schema
    names: list[str] = []
    for part in (match.group(1) if match else path).split("."):
        if not isinstance(dtype, T.StructType):
            return None
        fields = [f for f in dtype.fields if f.name == part] or [
            f for f in dtype.fields if f.name.lower() == part.lower()]
        if not fields:
            return None
        names.append(fields[0].name)
        dtype = fields[0].dataType
    if position is not None:
        if not isinstance(dtype, T.ArrayType):
            return None
        dtype = dtype.elementType
    return Resolved(tuple(names), position, dtype)


def safe_col(schema: T.StructType, path: str, dtype: str | T.DataType | None = None) -> Column:
    """The column at ``path``, or a null where the schema lacks it.

    With ``dtype`` the column has that type either way, and values that do not fit it are
    null; without, a found column stays as it is and a missing one is text.
    """
    found = resolve(schema, path)
    if not found:
        return F.lit(None).cast(dtype or "string")
    return found.column().try_cast(dtype) if dtype else found.column()


def leaf_paths(schema: T.StructType) -> list[tuple[tuple[str, ...], T.DataType]]:
    """Every non-struct field of ``schema`` at any depth, in schema order."""

    def walk(struct: T.StructType, parents: tuple[str, ...]) -> Iterator:
        for field in struct.fields:
            here = (*parents, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from walk(field.dataType, here)
            else:
                yield here, field.dataType

    return list(walk(schema, ()))
