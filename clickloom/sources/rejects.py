"""Malformed lines kept apart from good rows, in the pass that writes both.

A split table has two folders, ``rejected=false`` with the good rows and ``rejected=true``
with what each malformed line said and where it stood.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators.flatten import flatten_event
from clickloom.schemas import CORRUPT
from clickloom.sources.writers import read_back, write_table

REJECTED, REJECT = "rejected", "reject"
REJECT_SCHEMA = T.StructType().add("file", "string").add("block_start", T.LongType()).add("text", "string")


def marked(raw: DataFrame) -> DataFrame:
    """``raw``, read from files with a column for malformed lines, with ``rejected`` and ``reject``."""
    bad = F.col(CORRUPT).isNotNull()
    origin = F.struct(F.col("_metadata.file_path").alias("file"),
                      F.col("_metadata.file_block_start").alias("block_start"), F.col(CORRUPT).alias("text"))
    return raw.select("*", bad.alias(REJECTED), F.when(bad, origin).alias(REJECT))


def write_split(raw: DataFrame, path: str, fmt: str = "parquet", *,
                transform: Callable[..., DataFrame] = flatten_event, partition_by: Sequence[str] = (),
                **kwargs) -> None:
    """Write ``transform(raw)`` and the malformed lines of ``raw`` to ``path`` in one pass.

    ``transform`` works row by row and hands the columns named by its argument ``keep`` on.
    """
    rows = transform(marked(raw), keep=(REJECTED, REJECT))
    write_table(rows, path, fmt, partition_by=[REJECTED, *partition_by], **kwargs)


def read_accepted(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The good rows of a split table; the folder of the others is not opened."""
    whole = T.StructType([*schema.fields, T.StructField(REJECTED, T.BooleanType())])
    return read_back(spark, path, whole, fmt).where(~F.col(REJECTED)).select(*schema.names)


def read_rejects(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``file, block_start, text`` of the malformed lines of a split table."""
    whole = T.StructType([T.StructField(REJECT, REJECT_SCHEMA), T.StructField(REJECTED, T.BooleanType())])
    return read_back(spark, path, whole, fmt).where(REJECTED).select(f"{REJECT}.*")


def split_metrics(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``(metric, value)``: lines, good rows and malformed lines of a split table."""
    whole = T.StructType([T.StructField(REJECTED, T.BooleanType())])
    counted = read_back(spark, path, whole, fmt).agg(
        F.count(F.lit(1)).alias("line_count"), F.count_if(~F.col(REJECTED)).alias("accepted_count"),
        F.count_if(F.col(REJECTED)).alias("corrupt_count"))
    return counted.unpivot([], counted.columns, "metric", "value")
