"""The daily job: read, flatten, write, read back, reconcile."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickloom.operators.flatten import flatten_event
from clickloom.operators.reconcile import reconcile
from clickloom.schemas import METRIC_SCHEMA
from clickloom.sources.events import join_path, read_events
from clickloom.sources.files import file_inventory
from clickloom.sources.rejects import read_accepted, write_split
from clickloom.sources.writers import read_back, write_table


def daily_load(spark: SparkSession, source: str, target: str, metrics: str, *, fmt: str = "json",
               pk: str = "messageId", pattern: str = "*", rejects: bool = False) -> DataFrame | None:
    """Load one day folder; returns the stored metrics, ``None`` for an empty folder.

    With ``rejects`` malformed lines are kept apart, see ``sources.rejects``, and the metrics
    count them.

    The write parses all fields; the source counts parse the lines a second time for
    the key alone, which at scale is cheaper than caching the whole day.
    """
    if file_inventory(spark, source).isEmpty():
        return None
    raw = read_events(spark, join_path(source, pattern))
    events = flatten_event(raw)
    if rejects:
        write_split(raw, target, fmt)
        written = read_accepted(spark, target, events.schema, fmt)
    else:
        write_table(events, target, fmt)
        written = read_back(spark, target, events.schema, fmt)
    write_table(reconcile(raw, written, pk, extra=rejects), metrics, "json")
    return read_back(spark, metrics, METRIC_SCHEMA, "json")
