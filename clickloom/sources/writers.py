"""Sinks and read-back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rebalanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows grouped by ``columns`` in partitions of even size; large groups are split."""
    return df.hint("rebalance", *columns)


def write_table(df: DataFrame, path: str | None = None, fmt: str = "parquet", *,
                mode: str = "overwrite", partition_by: Sequence[str] = (),
                rebalance: bool = False, options: dict[str, str] | None = None) -> None:
    """Write ``df``; ``fmt`` is any Spark format, ``jdbc`` for a warehouse table.

    ``rebalance`` shuffles by the partition columns first, so that every folder gets
    few, full files; adaptive execution splits a large folder over several tasks.
    Leave it off when tasks already hold one folder each, as with day-wise input.
    """
    if rebalance and partition_by:
        df = rebalanced(df, partition_by)
    writer = df.write.format(fmt).mode(mode).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path) if path else writer.save()


def write_counted(df: DataFrame, path: str, fmt: str = "parquet", *,
                  partition_by: Sequence[str] = (), rebalance: bool = False, **kwargs) -> int:
    """:func:`write_table` that also returns the rows written, counted on the way.

    The count sits after any shuffle, in the tasks that write: Spark takes each of
    these into account once, also when it has to repeat lost ones.
    """
    if rebalance and partition_by:
        df = rebalanced(df, partition_by)
    observed = Observation()
    write_table(df.observe(observed, F.count(F.lit(1)).alias("rows")), path, fmt,
                partition_by=partition_by, **kwargs)
    return observed.get["rows"]


def read_back(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "json",
              options: dict[str, str] | None = None) -> DataFrame:
    """Read a written table with the schema it was written with.

    Inference would lose columns that are null throughout, and turn times into text.
    """
    return spark.read.format(fmt).schema(schema).options(**(options or {})).load(path)
