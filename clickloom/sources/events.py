"""Readers for event logs, readings and stored metrics."""

from __future__ import annotations

import json
from contextlib import contextmanager
from functools import reduce
from itertools import product
from operator import or_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.schemas import CORRUPT, METRIC_SCHEMA, READING_SCHEMA, event_schema


def join_path(base: str, *parts: str) -> str:
    """Join folder names with single slashes."""
    return "/".join([base.rstrip("/"), *[part.strip("/") for part in parts if part.strip("/")]])


def day_paths(root: str, days, source: str = "*") -> list[str]:
    """The folders ``<root>/<source>/<day>`` of the given epoch-millisecond days."""
    return [join_path(root, source, str(day)) for day in days]


def read_events(spark: SparkSession, path, schema: T.StructType | str | None = None, *,
                partitions: int | None = None) -> DataFrame:
    """JSON lines, plain or gzip, with the event schema or one of your own.

    A malformed line becomes a row of nulls with its text in ``_corrupt_record``.
    A gzip file cannot be split: ``partitions`` spreads the rows of large ones.
    """
    events = spark.read.schema(schema or event_schema()).json(path)
    return events.repartition(partitions) if partitions else events


def infer_schema(spark: SparkSession, path, sampling_ratio: float = 1.0) -> T.StructType:
    """The schema found in the data. Costs a pass: keep it with :func:`save_schema`."""
    return spark.read.option("samplingRatio", sampling_ratio).json(path).schema


def save_schema(spark: SparkSession, schema: T.StructType, path: str) -> None:
    spark.createDataFrame([(schema.json(),)], "value STRING").coalesce(1).write.mode(
        "overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(spark.read.text(path).first()[0]))


def read_events_any_case(spark: SparkSession, path, schema: T.StructType | None = None) -> DataFrame:
    """Events whose keys are spelled as in ``schema`` or in lower case, even mixed.

    JSON keys are matched by case, so one of two spellings would read as null. Each
    line is parsed once into a variant and every leaf takes the first spelling found.
    """
    schema = schema or event_schema(corrupt=False)
    lines = spark.read.text(path).filter(F.trim("value") != "").select(
        "value", F.try_parse_json("value").alias("_v"))

    def value_of(names: tuple[str, ...], dtype: T.DataType) -> Column:
        spellings = product(*[dict.fromkeys((name, name.lower())) for name in names])
        return F.coalesce(*[
            F.try_variant_get("_v", "$" + "".join(f"['{n}']" for n in spelled), dtype.simpleString())
            for spelled in spellings])

    def build(struct: T.StructType, parents: tuple[str, ...]) -> list[Column]:
        columns = []
        for field in struct.fields:
            here = (*parents, field.name)
            if isinstance(field.dataType, T.StructType):
                parts = build(field.dataType, here)
                found = reduce(or_, [part.isNotNull() for part in parts])
                columns.append(F.when(found, F.struct(*parts)).alias(field.name))
            else:
                columns.append(value_of(here, field.dataType).alias(field.name))
        return columns

    corrupt = F.when(F.col("_v").isNull(), F.col("value")).alias(CORRUPT)
    return lines.select(*build(schema, ()), corrupt)


def read_readings(spark: SparkSession, path, schema: T.StructType | str | None = READING_SCHEMA, *,
                  infer: bool = False) -> DataFrame:
    """CSV with a header; ``infer`` replaces the schema by an extra inference pass."""
    if infer:
        return spark.read.csv(path, header=True, inferSchema=True)
    return spark.read.schema(schema).csv(path, header=True)


def metric_preview(spark: SparkSession, path: str, n: int = 5,
                   schema: T.StructType | str = METRIC_SCHEMA) -> DataFrame:
    """The first ``n`` rows of every ``.json`` file below ``path``, in file order.

    The rank filter is applied inside each task before the shuffle, so a large file
    sends ``n`` rows per block.
    """
    rows = (spark.read.schema(schema).option("pathGlobFilter", "*.json")
            .option("recursiveFileLookup", "true").json(path)
            .select("*", F.col("_metadata.file_path").alias("file_path"),
                    F.col("_metadata.file_block_start").alias("_block"),
                    F.monotonically_increasing_id().alias("_pos")))
    rank = F.row_number().over(Window.partitionBy("file_path").orderBy("_block", "_pos"))
    return (rows.withColumn("row_in_file", rank).filter(F.col("row_in_file") <= n)
            .drop("_block", "_pos"))


@contextmanager
def persisted(df: DataFrame):
    """``df`` kept in memory and on disk while several actions use it."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()
