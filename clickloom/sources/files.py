"""File and folder inventory: names, sizes and times, without reading any content."""

from __future__ import annotations

import fnmatch
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.schemas import DAY_MS
from clickloom.session import scratch_path

_LISTED = "path STRING, length BIGINT, modificationTime TIMESTAMP, is_folder BOOLEAN"


def qualified(root: str) -> str:
    """``root`` with its scheme, absolute and with single slashes, as Spark would open it."""
    spark = SparkSession.active()
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return found if found.endswith("/") and found.count("/") <= 3 else found.rstrip("/")


def _list_folders(batches):
    """All entries of each folder; a folder that is gone or is a file has none."""
    from pyarrow import fs
    for batch in batches:
        for folder in batch.column("path").to_pylist():
            scheme, _, plain = folder.partition(":")
            if scheme == "file":
                system, inner, prefix = fs.LocalFileSystem(), "/" + plain.lstrip("/"), "file:"
            else:
                system, inner = fs.FileSystem.from_uri(quote(folder, safe=":/@?&=%+"))
                prefix = folder[:len(folder) - len(inner)] if folder.endswith(inner) else folder.split("://")[0] + "://"
            entries = system.get_file_info(fs.FileSelector(inner, allow_not_found=True)) \
                if system.get_file_info(inner).type == fs.FileType.Directory else []
            for start in range(0, len(entries), 10_000):
                part = entries[start:start + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([prefix + e.path for e in part], pa.string()),
                     pa.array([e.size if e.is_file else 0 for e in part], pa.int64()),
                     pa.array([e.mtime for e in part], pa.timestamp("us", "UTC")),
                     pa.array([not e.is_file for e in part], pa.bool_())],
                    ["path", "length", "modificationTime", "is_folder"])


def file_inventory(spark: SparkSession, root: str, pattern: str | None = None, *,
                   hidden: bool = True) -> DataFrame:
    """``path, length, modificationTime`` of every file below ``root``, of any name and size.

    ``pattern`` filters file names, such as ``*.json``; ``hidden=False`` leaves out names
    beginning with ``_`` or ``.``, and what is in such folders. A missing folder gives an
    empty inventory, not an error; a store that no lister knows is an error.

    The tree is listed level by level. Tasks take folders and write what they find to the
    shared scratch folder, so the driver holds no names; the largest unit of work is one
    folder's own entries.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shown = F.lit(True) if hidden else ~F.element_at(F.split("path", "/"), -1).rlike("^[_.]")
    frontier = spark.createDataFrame([(qualified(root),)], "path STRING")
    found = None
    while True:
        where = scratch_path(spark, "inventory")
        (frontier.repartition(tasks, "path").mapInArrow(_list_folders, _LISTED)
         .filter(shown).write.parquet(where))
        level = spark.read.schema(_LISTED).parquet(where)
        files = level.filter(~F.col("is_folder")).drop("is_folder")
        found = files if found is None else found.unionByName(files)
        frontier = level.filter("is_folder").select("path")
        if frontier.isEmpty():
            break
    if pattern:
        matches = fnmatch.translate(pattern).replace("(?s:", "(?s)(?:").replace("\\Z", "$").replace("\\z", "$")
        found = found.filter(F.element_at(F.split("path", "/"), -1).rlike("^" + matches))
    return found


def relative_path(root: str, path: Column | None = None) -> Column:
    """The part of ``path`` below ``root``; an error for a path that is not below it.

    Both are compared without scheme, with single slashes and ``root`` made absolute.
    """
    def plain(column: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(
            column, r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?", ""), "/+", "/")

    base = plain(F.lit(qualified(root) + "/"))
    full = plain(F.col("path") if path is None else path)
    return F.when(F.startswith(full, base), F.substring(full, F.length(base) + 1, F.length(full))).otherwise(
        F.raise_error(F.concat(F.lit("not below "), base, F.lit(": "), full)).cast("string"))


def volume(inventory: DataFrame, *keys: str) -> DataFrame:
    """``n_files`` and ``size_kb`` (two decimals), in total or per ``keys``."""
    return inventory.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.round(F.coalesce(F.sum("length"), F.lit(0)) / 1024, 2).alias("size_kb"))


def folder_names(inventory: DataFrame, root: str, level: int = 1) -> DataFrame:
    """Distinct names of the folders ``level`` steps below ``root``.

    Folders are known by the files in them; object stores have no empty ones.
    """
    parts = F.split(relative_path(root), "/")
    return (inventory.filter(F.size(parts) > level)
            .select(F.element_at(parts, level).alias("folder")).distinct())


def folder_volume(inventory: DataFrame, root: str, level: int = 1, name: str = "day_ms") -> DataFrame:
    """:func:`volume` per day folder, see :func:`day_of`; other folders do not count."""
    folder = F.get(F.split(relative_path(root), "/"), F.lit(level - 1))
    keyed = inventory.withColumn(name, day_of(folder))
    return volume(keyed.filter(F.col(name).isNotNull()), name)


def day_of(folder: Column) -> Column:
    """The day key of a folder named by a midnight in epoch milliseconds, alone or as
    ``<name>=<midnight>``; null for any other name."""
    number = F.regexp_extract(folder, r"^(?:[^=]+=)?(\d+)$", 1).try_cast("bigint")
    return F.when(number % DAY_MS == 0, number)


def odd_folders(inventory: DataFrame, root: str, level: int = 1) -> DataFrame:
    """Names of the folders at ``level`` that are no day folders."""
    return folder_names(inventory, root, level).filter(day_of(F.col("folder")).isNull())


def last_files(inventory: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` last files by path, last one first."""
    return inventory.orderBy(F.desc("path")).limit(n)
