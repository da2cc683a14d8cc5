"""Text lines of reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.paths import quoted


def with_text(df: DataFrame, template: str, columns: Sequence[str], name: str = "line") -> DataFrame:
    """Add a report line: ``template`` filled printf-style from ``columns``."""
    return df.withColumn(name, F.format_string(template, *[F.col(quoted(c)) for c in columns]))
