"""Incremental ingest: each version of a file once, however old, whatever fails in between."""

from __future__ import annotations

import inspect
import json
import re
from collections.abc import Callable, Sequence
from itertools import islice

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from clickloom.operators.flatten import flatten_event
from clickloom.operators.reconcile import reconcile
from clickloom.schemas import event_schema
from clickloom.sources.events import join_path
from clickloom.session import scratch_path
from clickloom.sources.files import file_inventory
from clickloom.sources.rejects import REJECT, REJECT_SCHEMA, REJECTED, marked, read_accepted
from clickloom.sources.writers import read_back, write_table
from clickloom.streaming.ledger import FILE_COLUMNS, FILE_DDL, file_columns, file_status, read_ledger, superseded


# By default the file source never loads a file that is a week older than the newest one.
ANY_AGE = "36500d"


def file_stream(spark: SparkSession, schema: T.StructType | str) -> DataStreamReader:
    """A reader of new files that skips none for its modification time."""
    return spark.readStream.schema(schema).option("maxFileAge", ANY_AGE)


def _query_of(spark: SparkSession, checkpoint: str) -> str | None:
    """The id of the query that a checkpoint belongs to, if it has been used."""
    try:
        return json.loads(spark.read.text(join_path(checkpoint, "metadata")).first()[0])["id"]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


class ChangedFiles(ValueError):
    """Loaded files were written again, and the call does not reload them."""


def ledger_of(target: str) -> str:
    """Where the ledger of a target is: beside it."""
    return target.rstrip("/") + "_ledger"


def ingest_available(spark: SparkSession, source: str, target: str, metrics: str, checkpoint: str,
                     *, schema: T.StructType | None = None, pk: str = "messageId",
                     transform: Callable[..., DataFrame] = flatten_event,
                     partition_by: Sequence[str] = ("ymd",), max_files: int | None = None,
                     changed: str = "error", rejects: bool = False) -> None:
    """Load all files below ``source`` that no earlier call has loaded, then return.

    Every micro-batch overwrites its own ``query=/batch_id=`` folder of ``target`` (Parquet,
    see :func:`read_ingested`), ``metrics`` (JSON) and the ledger of its files, where the query
    is the one of the checkpoint. A batch repeated after a failure therefore replaces its own
    output, and the checkpoint moves on only after all writes succeeded. A target with files of
    another checkpoint is refused: they would be loaded twice. ``partition_by`` lays out the
    folders inside a batch.

    Files that were written again since they were loaded are known from the ledger, without
    opening any data file. By default they are an error, before anything is loaded; with
    ``changed="reload"`` they are loaded in batches with numbers below zero, and the rows of
    their old versions are no longer read. Vanished files stay loaded, see
    ``streaming.ledger.file_status``. ``rejects`` keeps malformed lines apart, see
    ``sources.rejects``, and counts them. Both need a ``transform`` with an argument ``keep``.
    """
    if changed not in ("error", "reload"):
        raise ValueError(f"changed must be error or reload, not {changed}")
    keeps = "keep" in inspect.signature(transform).parameters
    if (rejects or changed == "reload") and not keeps:
        raise ValueError("the transform must hand on the columns named by its argument keep")
    schema = schema or event_schema()
    flat = transform(spark.createDataFrame([], schema)).schema if keeps else None
    own = _query_of(spark, checkpoint)
    entries = read_ledger(spark, ledger_of(target))
    others = {r[0] for r in entries.select("query").distinct().collect()} - {own}
    if others:
        raise ValueError(f"{target} was filled with another checkpoint, by {sorted(others)}")

    def load(batch: DataFrame, batch_id: int) -> None:
        folder = f"query={_query_of(spark, checkpoint)}/batch_id={batch_id}"
        place = join_path(target, folder)
        layout = [REJECTED, *partition_by] if rejects else partition_by
        events = transform(batch, keep=[*FILE_COLUMNS, *((REJECTED, REJECT) if rejects else ())]) if keeps else transform(batch)
        # Static: the whole folder is replaced, whatever days a failed attempt left in it.
        write_table(events, place, "parquet", partition_by=layout,
                    options={"partitionOverwriteMode": "static"})
        session = batch.sparkSession
        written = read_back(session, place, events.schema, "parquet")
        good = read_accepted(session, place, flat) if rejects else written
        # The source side needs the key only, so the second parse skips all other fields.
        write_table(reconcile(batch, good, pk, extra=rejects), join_path(metrics, folder), "json")
        seen = written if keeps else batch
        write_table(seen.select(*[F.col(c).alias(n) for c, n in zip(FILE_COLUMNS, ("path", "length", "modified"))]).distinct()
                    .coalesce(1), join_path(ledger_of(target), folder), "parquet")

    if own is not None:
        _load_changed(spark, source, schema, entries, changed, rejects, load)
    reader = file_stream(spark, schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    (_with_files(reader.json(source), rejects).writeStream.foreachBatch(load)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True)
     .start().awaitTermination())


def _with_files(raw: DataFrame, rejects: bool) -> DataFrame:
    tagged = marked(raw) if rejects else raw
    return tagged.select("*", *[column.alias(name) for name, column in file_columns().items()])


def _load_changed(spark: SparkSession, source: str, schema: T.StructType, entries: DataFrame, changed: str,
                  rejects: bool, load: Callable[[DataFrame, int], None], block: int = 1000) -> None:
    """Refuse or load files that were written again; ``block`` names are held at once."""
    root = re.split(r"[*?\[{]", source)[0].rpartition("/")[0] if re.search(r"[*?\[{]", source) else source
    again = stored_status(file_status(file_inventory(spark, root), entries).where("status = 'changed'"))
    if again.isEmpty():
        return
    if changed == "error":
        some = [r.path for r in again.select("path").orderBy("path").limit(20).collect()]
        raise ChangedFiles(f"{again.count()} loaded files were written again, among them {some}")
    number = min(entries.agg(F.min("batch_id")).head()[0], 0)
    names = (re.sub(r"([*?\[\]{}\\])", r"\\\1", r.file) for r in again.orderBy("path").toLocalIterator())
    while part := list(islice(names, block)):
        number -= 1
        load(_with_files(spark.read.schema(schema).json(part), rejects), number)


def stored_status(status: DataFrame) -> DataFrame:
    """Status rows at one point in time: the reload must not see its own ledger entries."""
    path = scratch_path(status.sparkSession, "file-status")
    write_table(status, path)
    return read_back(status.sparkSession, path, status.schema, "parquet")


def _ingested(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """Rows of published batches whose file version is the one loaded last, malformed lines included."""
    entries = read_ledger(spark, ledger_of(target))
    old = superseded(entries)
    whole = T.StructType([*schema.fields, *T.StructType.fromDDL(FILE_DDL).fields])
    loaded = read_back(spark, target, whole, "parquet")
    lowest = min(entries.agg(F.min("batch_id")).head()[0] or 0, 0)
    loaded = loaded.where(F.col("batch_id") >= lowest)  # a reload that failed is not published
    if lowest < 0:
        loaded = loaded.join(
            old, (loaded["_file"] == old["_file"]) & (F.unix_millis(loaded["_modified"]) == old["_millis"]), "left_anti")
    return loaded


def read_ingested(spark: SparkSession, target: str, schema: T.StructType | None = None) -> DataFrame:
    """All rows ingested into ``target``, with the ``batch_id`` that brought them; rejected
    lines and rows of replaced file versions are left out."""
    if schema is None:
        schema = flatten_event(spark.createDataFrame([], event_schema())).schema
    loaded = _ingested(spark, target, schema)
    if REJECTED in loaded.columns:
        loaded = loaded.where(~F.col(REJECTED).cast("boolean"))
    return loaded.select(*schema.names, "batch_id")


def read_ingested_rejects(spark: SparkSession, target: str) -> DataFrame:
    """``file, block_start, text, batch_id`` of the malformed lines of a target with ``rejects``."""
    loaded = _ingested(spark, target, T.StructType([T.StructField(REJECT, REJECT_SCHEMA)]))
    return loaded.where(F.col(REJECTED).cast("boolean")).select(f"{REJECT}.*", "batch_id")
