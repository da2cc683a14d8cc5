"""Daily metrics against their own past."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def against_history(metrics: DataFrame, by: Sequence[str], day: str = "day", value: str = "value", *,
                    days: int = 7, at_least: int = 3, share: float = 0.5) -> DataFrame:
    """Each row of ``metrics`` with what its metric was before.

    ``by`` names the columns that tell the metrics apart, ``day`` is a date and ``value`` a
    number, one row for each metric and day. Added are

    * ``previous_value`` and ``days_since`` of the row before, however long ago (null at first);
    * ``usual_value``, the median of the ``days`` calendar days before, and ``n_usual``, how
      many of them have a value;
    * ``status``: ``no value`` for a null; ``first`` without an earlier row; ``after gap`` if
      the day before has no row; ``new`` with fewer than ``at_least`` values to compare with;
      ``low`` or ``high`` if the value is more than ``share`` of the median below or above
      it; else ``usual``.

    Rows without a day are left out, as they have no past. Of several rows with one day each
    sees the rows of earlier days in its median, and the others of its day as previous.
    Window frames reach ``days`` back at most, so memory does not grow with the history; a
    partition holds the days of one metric.
    """
    dated = metrics.where(F.col(day).isNotNull()).withColumn("_day", F.unix_date(F.to_date(day)))
    in_order = Window.partitionBy(*by).orderBy("_day", value)
    before = Window.partitionBy(*by).orderBy("_day").rangeBetween(-days, -1)
    seen = dated.withColumns({
        "previous_value": F.lag(value).over(in_order),
        "days_since": F.col("_day") - F.lag("_day").over(in_order),
        "usual_value": F.percentile(F.col(value), F.lit(0.5)).over(before),
        "n_usual": F.count(value).over(before),
    })
    usual, margin = F.col("usual_value"), F.abs("usual_value") * share
    status = (
        F.when(F.col(value).isNull(), "no value")
        .when(F.col("days_since").isNull(), "first")
        .when(F.col("days_since") > 1, "after gap")
        .when(F.col("n_usual") < at_least, "new")
        .when(F.col(value) < usual - margin, "low")
        .when(F.col(value) > usual + margin, "high")
        .otherwise("usual"))
    return seen.withColumn("status", status).drop("_day")
