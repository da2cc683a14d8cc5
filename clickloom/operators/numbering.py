"""Dense numbering within a key that never gathers a key in one task."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.paths import quoted
from clickloom.session import checkpointed


def number_rows(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Number the rows of each key 1..n, in no particular order.

    Rows are ranked inside (key, input partition), then shifted by the number of
    rows the key has in earlier partitions. The largest group in a task is thus one
    input partition, whatever share of the rows a key holds. Partition ids are not
    reproducible on recomputation, so they are pinned by a reliable checkpoint.
    """
    tagged = checkpointed(df.withColumns({
        "_part": F.spark_partition_id(), "_pos": F.monotonically_increasing_id()}))
    by = [F.col(quoted(key)) for key in keys]
    renamed = [f"_key_{i}" for i in range(len(keys))]
    counts = tagged.groupBy(*[c.alias(n) for c, n in zip(by, renamed)],
                            F.col("_part").alias("_of_part")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*renamed).orderBy("_of_part").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    same = reduce(and_, [c.eqNullSafe(F.col(n)) for c, n in zip(by, renamed)],
                  F.col("_part") == F.col("_of_part"))
    rank = F.row_number().over(Window.partitionBy(*by, "_part").orderBy("_pos"))
    return (tagged.withColumn("_rank", rank).join(offsets, same)
            .withColumn(name, F.col("_before") + F.col("_rank"))
            .drop("_part", "_pos", "_rank", "_of_part", "_rows", "_before", *renamed))
