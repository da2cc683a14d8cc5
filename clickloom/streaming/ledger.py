"""What has been loaded from which file: one entry for each file and batch.

A ledger is a Parquet folder ``query=/batch_id=/`` beside a target. Against an inventory it
tells new, changed and vanished files without opening a data file.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "path STRING, length BIGINT, modified TIMESTAMP"
FILE_DDL = "_file STRING, _length BIGINT, _modified TIMESTAMP"   # of rows that know their file
FILE_COLUMNS = ("_file", "_length", "_modified")
_READ = f"{ENTRY}, query STRING, batch_id BIGINT"


def plain_path(path: Column) -> Column:
    """A path without scheme and host, so that names from different listings agree."""
    return F.regexp_replace(F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?", ""), "/+", "/")


def file_columns() -> dict[str, Column]:
    """Where a row of a file source came from: plain path, length and modification time."""
    # the source gives an escaped URI, in which a plus sign stands for itself
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return {"_file": plain_path(decoded), "_length": F.col("_metadata.file_size"),
            "_modified": F.col("_metadata.file_modification_time")}


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All entries with their ``query`` and ``batch_id``; none if there is no ledger yet."""
    try:
        return spark.read.schema(_READ).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _READ)


def _version() -> Column:
    # listings differ in what they know below a millisecond
    return F.struct(F.unix_millis("modified").alias("modified"), "length")


def newest(entries: DataFrame) -> DataFrame:
    """``path, loaded``: what was loaded last from each file, as (modified, length)."""
    return entries.groupBy("path").agg(F.max(_version()).alias("loaded"))


def file_status(inventory: DataFrame, entries: DataFrame) -> DataFrame:
    """``path, file, status``: ``new``, ``loaded``, ``changed`` or ``vanished``, one row for each
    file of the inventory or the ledger; ``file`` is its name in the inventory. One join on the path."""
    here = inventory.select(
        plain_path(F.col("path")).alias("path"), F.col("path").alias("file"), "length",
        F.col("modificationTime").alias("modified")).select("path", "file", _version().alias("found"))
    return here.join(newest(entries), "path", "full_outer").select(
        "path", "file", F.when(F.col("loaded").isNull(), "new").when(F.col("found").isNull(), "vanished")
        .when(F.col("found") == F.col("loaded"), "loaded").otherwise("changed").alias("status"))


def superseded(entries: DataFrame) -> DataFrame:
    """``_file, _millis``: versions of files that a later load has replaced."""
    every = entries.select("path", F.unix_millis("modified").alias("_millis"), _version().alias("own")).distinct()
    return every.join(newest(entries), "path").where("own <> loaded").select(F.col("path").alias("_file"), "_millis")
