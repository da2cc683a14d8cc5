"""The provided Parquet tables, and the nested event log made from ``events``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.calendar import day_ms


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_log(events: DataFrame) -> DataFrame:
    """``events`` in the nested shape of the event schema.

    A third of the rows has a hospital array of two elements, a third of one, a third
    none; every seventh user has no ``userId``.
    """
    k = F.col("_k")
    kind = F.col("event_type")
    user = F.col("user_id").cast("string")

    def hospital(name_prefix: str) -> Column:
        number = k.cast("string")
        return (F.when(k % 3 == 0, F.array(number, F.concat(F.lit(name_prefix), number)))
                .when(k % 3 == 1, F.array(number)))

    return events.withColumn("_k", F.from_json("props", "k INT")["k"]).select(
        user.alias("anonymousId"),
        F.struct(
            F.concat(F.lit("agent/"), F.col("user_id") % 5).alias("userAgent"),
            F.concat(F.lit("10.0.0."), F.col("user_id") % 256).alias("ip"),
            F.when(F.col("user_id") % 2 == 0, "ko-KR").otherwise("en-US").alias("locale"),
            F.struct(F.concat(F.lit("/"), kind).alias("url")).alias("page"),
        ).alias("context"),
        F.concat(F.lit("m-"), F.col("event_id")).alias("messageId"),
        k.cast("string").alias("hospitalId"),
        F.struct(
            F.concat(F.lit("/p/"), kind).alias("path"),
            kind.alias("page"),
            F.struct(F.concat(F.lit("b-"), kind).alias("name"),
                     hospital("B").alias("hospital")).alias("button"),
            F.struct(F.concat(F.lit("a-"), kind).alias("name"),
                     hospital("A").alias("hospital")).alias("action"),
            F.struct(k.cast("string").alias("hospitalId"), kind.alias("pageName"),
                     F.lit(None).cast("string").alias("routeName"),
                     F.concat(F.lit("to-"), k).alias("to")).alias("properties"),
        ).alias("properties"),
        kind.alias("event"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.lit("track").alias("type"),
        F.when(F.col("user_id") % 7 != 0, user).alias("userId"),
    )


def day_log(events: DataFrame) -> DataFrame:
    """:func:`event_log` with the folder columns ``source`` and ``day_ms``."""
    log = event_log(events)
    return log.select(
        "*", F.col("event").alias("source"),
        day_ms(log, "timestamp").alias("day_ms"))
