"""Sessions of a log that arrives in loads, with numbers and next starts over all of them.

A folder carries four tables, each with one subfolder per load:

* ``slots``: (user, slot) with first, last and number of events, see ``operators.sessions``,
  laid out by day. Only late events read it again.
* ``state``: one row for each user: last event, and start and number of the open session.
* ``settled``: sessions whose next start is known.
* ``cuts``: (user, number): earlier loads' sessions of the user from that number on are void.

A load folds its own events into slots and meets ``state`` by one join on the user. Users
whose new events come after their open session began continue from it. For the others, late
events, sessions are cut at the last one that began before the first new event and made again
from the slots since then. An event without a time stands before all others, so it makes its
user's sessions again from the first. Everything else stays untouched; only ``state`` is
written anew, at one row for each user.

A load is published by a line in ``versions``, written last. One that fails leaves the loads
before it as they were and is replaced by the next one. There must be one writer at a time.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.paths import quoted
from clickloom.operators.sessions import gap_in_seconds, one_session_per_row, slot_of
from clickloom.schemas import SESSION_GAP_MINUTES
from clickloom.session import checkpointed
from clickloom.sources.events import join_path
from clickloom.sources.writers import write_table

_DAY_SECONDS = 86_400
# {u}: type of the user column, {t}: type of the time column
_TABLES = {
    "slots": "user {u}, slot BIGINT, first {t}, last {t}, n BIGINT, day BIGINT",
    "state": "user {u}, number BIGINT, open_start {t}, last {t}",
    "settled": "user {u}, number BIGINT, session_start_at {t}, next_session_start_at {t}",
    "cuts": "user {u}, from_number BIGINT",
}


def loads(spark: SparkSession, root: str) -> list[dict]:
    """Name and settings of every published load, the first one first: one line each."""
    try:
        lines = spark.read.text(join_path(root, "versions")).select("value").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((json.loads(line[0]) for line in lines), key=lambda load: load["version"])


def _table(spark: SparkSession, root: str, name: str, load: dict) -> DataFrame:
    """All rows of a table up to ``load``, with the version ``v`` that brought them."""
    schema = T.StructType.fromDDL(_TABLES[name].format(u=load["user_type"], t=load["ts_type"])).add("v", T.IntegerType())
    return spark.read.schema(schema).parquet(join_path(root, name)).where(F.col("v") <= load["version"])


def _same_user(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _valid(spark: SparkSession, root: str, load: dict) -> DataFrame:
    """Settled sessions that no later load has cut off."""
    cuts = _table(spark, root, "cuts", load).select(
        F.col("user").alias("_user"), "from_number", F.col("v").alias("_v"))
    void = (_same_user("user", "_user") & (F.col("v") < F.col("_v")) & (F.col("number") >= F.col("from_number")))
    return _table(spark, root, "settled", load).join(cuts, void, "left_anti")


def load_sessions(events: DataFrame, root: str, name: str, user: str = "anonymousId", ts: str = "timestamp",
                  gap_minutes: float = SESSION_GAP_MINUTES) -> bool:
    """Add ``events`` to the sessions carried in ``root``; false if a load of that ``name`` is there.

    Loads may come in any order and may overlap in time. All must agree in the columns, their
    types and the gap, else this is an error. See :func:`carried_sessions` for the result.
    """
    spark, gap = events.sparkSession, gap_in_seconds(gap_minutes)
    types = {f.name: f.dataType.simpleString() for f in events.select(
        F.col(quoted(user)).alias("user"), F.col(quoted(ts)).alias("ts")).schema}
    settings = {"user": user, "ts": ts, "user_type": types["user"], "ts_type": types["ts"], "gap": gap}
    before = loads(spark, root)
    if any(load["name"] == name for load in before):
        return False
    last = before[-1] if before else None
    if last and {key: last[key] for key in settings} != settings:
        raise ValueError(f"the sessions in {root} were loaded with {last}, not with {settings}")
    this = {"version": last["version"] + 1 if last else 1, "name": name, **settings}

    def write(df: DataFrame, table: str, **options) -> None:
        write_table(df, join_path(root, table, f"v={this['version']}"), **options)

    moment = F.col(quoted(ts))
    slots = events.groupBy(F.col(quoted(user)).alias("user"), slot_of(moment, gap).alias("slot")).agg(
        F.min(moment).alias("first"), F.max(moment).alias("last"), F.count(F.lit(1)).alias("n"))
    write(slots.withColumn("day", F.floor(F.col("slot") / _DAY_SECONDS)), "slots", partition_by=["day"], rebalance=True)
    new = _table(spark, root, "slots", this).where(F.col("v") == this["version"]).drop("v", "day")
    touched = new.groupBy("user").agg(
        F.min("first").alias("earliest"), F.max(F.col("slot").isNull()).alias("untimed"))

    base = F.lit(None).cast("bigint").alias("base")
    if last:
        state = _table(spark, root, "state", last).where(F.col("v") == last["version"]).drop("v")
        known = checkpointed(touched.join(state.withColumnRenamed("user", "_user"), _same_user("user", "_user")).drop("_user"))
        is_late = F.col("untimed") | F.col("open_start").isNull() | (F.col("earliest") < F.col("open_start"))
        again, cuts = _made_again(spark, root, last, this, known.where(is_late), gap)
        going_on = known.where(~is_late).select(
            "user", slot_of(F.col("open_start"), gap).alias("slot"), F.col("open_start").alias("first"), "last",
            F.lit(1).cast("bigint").alias("n"), (F.col("number") - 1).alias("base"))
        in_time = new.join(cuts.select(F.col("user").alias("_user")), _same_user("user", "_user"), "left_anti")
        rows = in_time.select("*", base).unionByName(going_on).unionByName(again)
        untouched = state.join(touched.select(F.col("user").alias("_user")), _same_user("user", "_user"), "left_anti")
    else:
        rows, untouched = new.select("*", base), None
        cuts = spark.createDataFrame([], _TABLES["cuts"].format(u=types["user"]))

    starts, users = _numbered(rows, gap)
    write(starts, "settled")
    write(cuts, "cuts")
    write(users if untouched is None else users.unionByName(untouched), "state")
    (spark.createDataFrame([(json.dumps(this),)], "value STRING").coalesce(1).write.mode("overwrite")
     .text(join_path(root, "versions", f"v={this['version']}")))
    return True


def _made_again(spark: SparkSession, root: str, last: dict, this: dict, late: DataFrame,
                gap: int) -> tuple[DataFrame, DataFrame]:
    """The slots of ``late`` users from where their sessions are cut, and the cuts."""
    anchors = (_valid(spark, root, last).withColumnRenamed("user", "_user")
               .join(late.where(~F.col("untimed") & F.col("open_start").isNotNull()).select("user", "earliest"),
                     _same_user("user", "_user") & (F.col("session_start_at") <= F.col("earliest")))
               .groupBy("user").agg(F.max("number").alias("number"), F.max("session_start_at").alias("start"))
               .select(F.col("user").alias("_user"), F.col("number").alias("at"), "start"))
    cuts = checkpointed(late.select("user").join(anchors, _same_user("user", "_user"), "left").select(
        "user", F.coalesce("at", F.lit(1)).cast("bigint").alias("from_number"), slot_of(F.col("start"), gap).alias("from_slot")))
    # with one user made again from the first there is no bound
    bound = cuts.agg(F.when(F.count("from_slot") == F.count(F.lit(1)), F.floor(F.min("from_slot") / _DAY_SECONDS))).head()[0]
    slots = _table(spark, root, "slots", this)
    if bound is not None:
        slots = slots.where(F.col("day") >= bound)
    again = (slots.withColumnRenamed("user", "_user").join(
        cuts, _same_user("user", "_user") & (F.col("from_slot").isNull() | (F.col("slot") >= F.col("from_slot"))))
        .groupBy("user", "slot").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"),
                                     F.min(F.col("from_number") - 1).alias("base")))
    return again, cuts.select("user", "from_number")


def _numbered(rows: DataFrame, gap: int) -> tuple[DataFrame, DataFrame]:
    """Settled sessions and state of the users of ``rows(user, slot, first, last, n, base)``.

    The open session of a user, if among the rows, stands as one slot that may reach over
    others, so the idle time counts from the last event of all rows before.
    """
    of_user = Window.partitionBy("user")
    timeline = of_user.orderBy("slot", "first")
    idle = F.unix_timestamp("first") - F.max(F.unix_timestamp("last")).over(
        timeline.rowsBetween(Window.unboundedPreceding, -1))
    marked = rows.withColumn("start", F.coalesce(idle > gap, F.lit(True))).withColumn(
        "number", F.coalesce(F.max("base").over(of_user), F.lit(0)) + F.sum(
            F.when(F.col("slot").isNull(), F.col("n")).when(F.col("start"), 1).otherwise(0)).over(
            timeline.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    marked = checkpointed(marked.withColumn("total", F.max("number").over(of_user)))
    users = marked.groupBy("user").agg(
        F.max("number").alias("number"), F.max(F.when(F.col("start"), F.col("first"))).alias("open_start"),
        F.max("last").alias("last"))
    starts = marked.where("start").select(
        F.col("user").alias("_user"), "slot", "total", F.col("n").alias("_rows"), F.col("number").alias("_number"),
        F.col("first").alias("session_start_at"), F.lead("first").over(timeline).alias("next_session_start_at"))
    timed = starts.where(F.col("slot").isNotNull())
    every = timed.unionByName(one_session_per_row(starts.where(F.col("slot").isNull())))
    return every.where("_number < total").select(
        F.col("_user").alias("user"), F.col("_number").alias("number"), "session_start_at", "next_session_start_at"), users


def carried_sessions(spark: SparkSession, root: str) -> DataFrame:
    """``session_id, <user>, session_start_at, next_session_start_at`` of all loads, the same rows
    as ``session_table`` over all their events at once."""
    published = loads(spark, root)
    if not published:
        raise ValueError(f"{root} has no load")
    load = published[-1]
    opened = _table(spark, root, "state", load).where(F.col("v") == load["version"]).select(
        "user", "number", F.col("open_start").alias("session_start_at"),
        F.lit(None).cast(load["ts_type"]).alias("next_session_start_at"))
    every = _valid(spark, root, load).drop("v").unionByName(opened)
    return every.select(
        F.concat(F.col("user").cast("string"), F.lit("-"), F.col("number").cast("string")).alias("session_id"),
        F.col("user").alias(load["user"]), "session_start_at", "next_session_start_at")
