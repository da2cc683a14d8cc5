"""Source-against-target counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from clickloom.functions.paths import quoted
from clickloom.functions.report import with_text
from clickloom.schemas import CORRUPT, METRIC_SCHEMA
from clickloom.sources.writers import read_back, write_table


def count_metrics(df: DataFrame, pk: str, prefix: str = "", *, distinct: bool = True,
                  extra: bool = False) -> DataFrame:
    """``(metric, value)`` rows for one table, all from a single aggregation.

    ``<prefix>_pk_count`` counts rows, null keys included, and so equals
    ``<prefix>_total_row_count``; the distinct count takes null as one value.
    ``extra`` adds the number of null keys and, where known, of malformed lines.
    Keys are combined before the shuffle, so a frequent key costs one row per task.
    """
    key = F.col(quoted(pk))
    lead = f"{prefix}_" if prefix else ""
    rows = F.count(F.lit(1))
    nulls = F.count_if(key.isNull())
    measures = {f"{lead}pk_count": rows}
    if distinct:
        measures[f"distinct_{lead}pk_count"] = (
            F.count_distinct(key) + F.when(nulls > 0, 1).otherwise(0))
    measures[f"{lead}total_row_count"] = rows
    if extra:
        measures[f"{lead}null_pk_count"] = nulls
        if CORRUPT in df.columns:
            measures[f"{lead}corrupt_count"] = F.count_if(F.col(CORRUPT).isNotNull())
    counted = df.agg(*[value.cast("bigint").alias(name) for name, value in measures.items()])
    return counted.unpivot([], list(measures), "metric", "value")


def reconcile(source: DataFrame, target: DataFrame, pk: str, *, source_name: str = "DL",
              target_name: str = "DW", distinct: bool = True, extra: bool = False) -> DataFrame:
    """The metrics of both tables as one ``(metric, value)`` table."""
    return count_metrics(source, pk, source_name, distinct=distinct, extra=extra).unionByName(
        count_metrics(target, pk, target_name, distinct=distinct, extra=extra))


def write_reconciled(df: DataFrame, path: str, pk: str, fmt: str = "parquet", *,
                     source_name: str = "DL", target_name: str = "DW") -> DataFrame:
    """Write ``df`` and return its row and key counts and those of the table written.

    The source side is counted by the tasks that write, so ``df`` is computed once; see
    ``write_counted``. The distinct count needs the keys again: use :func:`reconcile`.
    """
    observed = Observation()
    write_table(df.observe(observed, F.count(F.lit(1)).alias("rows")), path, fmt)
    rows = observed.get["rows"]
    counted = df.sparkSession.createDataFrame(
        [(f"{source_name}_pk_count", rows), (f"{source_name}_total_row_count", rows)], METRIC_SCHEMA)
    written = read_back(df.sparkSession, path, df.schema, fmt)
    return counted.unionByName(count_metrics(written, pk, target_name, distinct=False))


def compare(source: DataFrame, target: DataFrame, pk: str, *, distinct: bool = True) -> DataFrame:
    """The metrics side by side: ``metric, source_value, target_value, matches``."""
    sides = [count_metrics(df, pk, distinct=distinct).withColumn("side", F.lit(side))
             for df, side in ((source, "source"), (target, "target"))]
    on = {side: F.max(F.when(F.col("side") == side, F.col("value"))) for side in ("source", "target")}
    return (sides[0].unionByName(sides[1]).groupBy("metric")
            .agg(on["source"].alias("source_value"), on["target"].alias("target_value"))
            .withColumn("matches", F.col("source_value").eqNullSafe(F.col("target_value"))))


def metric_lines(metrics: DataFrame) -> DataFrame:
    """Metrics with a text line for a report."""
    return with_text(metrics, "%s: %d", ["metric", "value"])


def not_null_count(df: DataFrame, path: str, name: str = "n") -> DataFrame:
    """How many rows have a value at a nested ``path``."""
    column = F.col(".".join(map(quoted, path.split("."))))
    return df.agg(F.count(column).alias(name))
