"""The registered queries: each runs one operator over whole provided tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from clickloom.functions.calendar import cast_columns, day_ms, with_calendar
from clickloom.functions.paths import leaf_paths
from clickloom.functions.report import with_text
from clickloom.operators.carried import carried_sessions, load_sessions
from clickloom.operators.children import child_tables
from clickloom.operators.contents import compare_contents
from clickloom.operators.days import day_status, missing_days, next_day
from clickloom.operators.extremes import extremes_report, largest
from clickloom.operators.flatten import add_safe_columns, event_view, flatten, flatten_event
from clickloom.operators.gaps import missing_ranges
from clickloom.operators.history import against_history
from clickloom.operators.reconcile import (
    compare, count_metrics, metric_lines, not_null_count, reconcile, write_reconciled)
from clickloom.operators.sessions import assign_sessions, session_table
from clickloom.plans.daily import daily_load
from clickloom.plans.tables import day_log, event_log, table
from clickloom.schemas import CORRUPT, METRIC_SCHEMA, event_schema
from clickloom.session import scratch_path
from clickloom.sources.events import (
    day_paths, infer_schema, load_schema, metric_preview, persisted, read_events, read_events_any_case, read_readings,
    save_schema)
from clickloom.sources.files import (
    day_of, file_inventory, folder_names, folder_volume, last_files, relative_path, volume)
from clickloom.sources.rejects import read_accepted, read_rejects
from clickloom.sources.spellings import infer_spellings, read_spelled
from clickloom.sources.writers import read_back, write_counted, write_table
from clickloom.streaming.ingest import file_stream, ingest_available, ledger_of, read_ingested
from clickloom.streaming.ledger import file_status, read_ledger
from clickloom.streaming.sessions import stream_sessions, write_available

# The 28 flat columns without the two retained structs.
_FLAT_SCALARS = ("context", "properties")
_LINE_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
# description, column, unit
_LINE_STATS = (
    ("Largest quantity", "l_quantity", "units"),
    ("Largest price", "l_extendedprice", "USD"),
    ("Largest discount", "l_discount", "share"),
    ("Largest tax", "l_tax", "share"),
    ("Largest net price", "net_price", "USD"),
)


def _json_log(spark: SparkSession, sf_dir: str, label: str) -> str:
    """``events`` written as JSON lines in the event schema; returns the folder."""
    path = scratch_path(spark, label)
    write_table(event_log(table(spark, sf_dir, "events")), path, "json")
    return path


def _day_folders(spark: SparkSession, sf_dir: str, label: str) -> str:
    """``events`` written as ``source=/day_ms=`` folders of JSON lines."""
    path = scratch_path(spark, label)
    write_table(day_log(table(spark, sf_dir, "events")), path, "json",
                partition_by=["source", "day_ms"], rebalance=True)
    return path


def _delivered_twice(spark: SparkSession, sf_dir: str, label: str) -> str:
    """``events`` in ``source=/day_ms=`` folders, each of which got its events in two deliveries."""
    path = scratch_path(spark, label)
    log = day_log(table(spark, sf_dir, "events"))
    is_even = F.col("anonymousId").cast("bigint") % 2 == 0
    for delivery in (log.where(is_even), log.where(~is_even)):
        write_table(delivery, path, "json", mode="append", partition_by=["source", "day_ms"], rebalance=True)
    return path


# -- sessions ---------------------------------------------------------------


def sessions_30m(spark, sf_dir):
    return session_table(table(spark, sf_dir, "events"), "user_id", "ts")


def sessions_6h(spark, sf_dir):
    return session_table(table(spark, sf_dir, "events"), "user_id", "ts", gap_minutes=360)


def sessions_of_types(spark, sf_dir):
    """Five keys that hold a fifth of all events each."""
    return session_table(table(spark, sf_dir, "events"), "event_type", "ts", gap_minutes=5,
                         keep_inactivity=True)


def sessions_all_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    return assign_sessions(events, "user_id", "ts", gap_minutes=360)


def sessions_from_log(spark, sf_dir):
    raw = read_events(spark, _json_log(spark, sf_dir, "session-log"))
    return session_table(flatten_event(raw), "anonymousId", "timestamp", gap_minutes=360)


def sessions_by_load(spark, sf_dir):
    """Sessions of ``events`` that arrive in loads of eight days, the second load after the third."""
    root = scratch_path(spark, "carried")
    events = table(spark, sf_dir, "events")
    events = events.select("user_id", "ts", (day_ms(events, "ts") / (8 * 86_400_000)).cast("bigint").alias("load"))
    first, last = events.agg(F.min("load"), F.max("load")).head()
    numbers = list(range(first, last + 1))
    for number in numbers[:1] + numbers[2:3] + numbers[1:2] + numbers[3:]:
        load_sessions(events.where(F.col("load") == number), root, str(number), "user_id", "ts")
    return carried_sessions(spark, root)


# -- calendar ---------------------------------------------------------------


def _calendar(spark, sf_dir, **options):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return with_calendar(events, "ts", **options)


def calendar_keys(spark, sf_dir):
    return _calendar(spark, sf_dir)


def calendar_keys_iso_local(spark, sf_dir):
    return _calendar(spark, sf_dir, basis="local", iso=True, week_key="yesterday")


def calendar_keys_orders(spark, sf_dir):
    """Dates over several years, so that year-end weeks occur."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    plain = with_calendar(orders, "o_orderdate").withColumnRenamed("yw", "yw_plain")
    return with_calendar(plain.select("o_orderkey", "o_orderdate", "yw_plain"), "o_orderdate",
                         iso=True)


# -- nested data ------------------------------------------------------------


def flatten_events(spark, sf_dir):
    raw = read_events(spark, _json_log(spark, sf_dir, "flatten"))
    return flatten_event(raw).drop(*_FLAT_SCALARS)


def safe_columns(spark, sf_dir):
    log = event_log(table(spark, sf_dir, "events"))
    added = add_safe_columns(log, {
        "page_url": "context.page.url",
        "page_title": "context.page.title",
        "hospital_name": "properties.action.hospital[1]",
        "hospital_rank": ("properties.action.rank", "bigint"),
        "absent_struct": "nothing.at.all",
        "any_case": "CONTEXT.useragent",
        "number": "properties.properties.hospitalid",
        "word": "event",
    })
    typed = cast_columns(added, ["number", "word", "not_there"], "bigint")
    return typed.select("messageId", "page_url", "page_title", "hospital_name", "hospital_rank",
                        "absent_struct", "any_case", "number", "word")


def array_elements(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return add_safe_columns(vectors.select("vec_id", "embedding"), {
        "first": ("embedding[0]", "float"),
        "second": ("embedding[1]", "float"),
        "beyond": ("embedding[100000]", "float"),
    }).drop("embedding")


def auto_flatten(spark, sf_dir):
    flat = flatten(event_log(table(spark, sf_dir, "events")), drop=["hospitalId", "not_there"])
    return flat.withColumns({name: F.concat_ws(",", name) for name in (
        "properties_button_hospital", "properties_action_hospital")})


def inferred_log(spark, sf_dir):
    """Infer the schema of a JSON log once, keep it, read with it, flatten all of it."""
    path = _json_log(spark, sf_dir, "inferred")
    kept = scratch_path(spark, "inferred-schema")
    save_schema(spark, infer_schema(spark, path), kept)
    log = read_events(spark, path, load_schema(spark, kept))
    assert leaf_paths(log.schema)
    return flatten(log).select("messageId", "context_page_url", "properties_properties_to", "userId")


def case_tolerant_log(spark, sf_dir):
    """A log in which half of the users send their keys in lower case."""
    path = scratch_path(spark, "any-case")
    text = F.to_json(F.struct("*"))
    lowered = F.regexp_replace(F.regexp_replace(F.regexp_replace(
        text, '"anonymousId"', '"anonymousid"'), '"messageId"', '"messageid"'),
        '"userAgent"', '"useragent"')
    log = event_log(table(spark, sf_dir, "events"))
    write_table(log.select(F.when(F.col("anonymousId").cast("bigint") % 2 == 0, lowered)
                           .otherwise(text).alias("value")), path, "text")
    return read_events_any_case(spark, path).select(
        "anonymousId", "messageId", F.col("context.userAgent").alias("user_agent"),
        F.col("context.page.url").alias("page_url"),
        F.get("properties.action.hospital", F.lit(0)).alias("hospital_id"))


def log_of_spellings(spark, sf_dir):
    """A log whose keys come in three spellings, by user, read by what inference finds."""
    path = scratch_path(spark, "spellings")
    text = F.to_json(F.struct("*"))
    log = event_log(table(spark, sf_dir, "events"))
    spelled = F.col("anonymousId").cast("bigint") % 3
    lowered = F.replace(F.replace(text, F.lit('"anonymousId"'), F.lit('"anonymousid"')), F.lit('"userAgent"'), F.lit('"useragent"'))
    raised = F.replace(F.replace(text, F.lit('"anonymousId"'), F.lit('"AnonymousID"')), F.lit('"context"'), F.lit('"Context"'))
    write_table(log.select(F.when(spelled == 0, lowered).when(spelled == 1, raised).otherwise(text).alias("value")), path, "text")
    return read_spelled(spark, path, infer_spellings(spark, path), event_schema(corrupt=False)).select(
        "anonymousId", "messageId", F.col("context.userAgent").alias("user_agent"),
        F.col("context.page.url").alias("page_url"),
        F.get("properties.action.hospital", F.lit(0)).alias("hospital_id"), F.col(CORRUPT).alias("corrupt"))


def event_hospital_rows(spark, sf_dir):
    """The elements of both hospital arrays of the log as child tables of its events."""
    tables = child_tables(event_log(table(spark, sf_dir, "events")), "messageId")
    parts = [tables[name].select(F.lit(name).alias("part"), F.col("row_key").alias("messageId"),
                                 F.get("at", F.lit(0)).cast("bigint").alias("position"), "value")
             for name in ("properties.action.hospital[]", "properties.button.hospital[]")]
    return parts[0].unionByName(parts[1])


def lines_of_nested_orders(spark, sf_dir):
    """Orders that hold their lines as an array of structs, taken apart into lines again."""
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    nested = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
              .agg(F.sort_array(F.collect_list(line)).alias("lines")))
    lines = child_tables(nested, "l_orderkey")["lines[]"]
    return lines.withColumnRenamed("row_key", "l_orderkey").withColumn("at", F.get("at", F.lit(0)).cast("bigint"))


def nested_sql_top5(spark, sf_dir):
    view = event_view(event_log(table(spark, sf_dir, "events")), "clickloom_events")
    return spark.sql(f"""
        SELECT messageid, anonymousid, context_page_url,
               array_join(properties_action_hospital, ',') AS hospital,
               properties_properties_to
        FROM ({view}) ORDER BY messageid LIMIT 5""")


def not_null_hospitals(spark, sf_dir):
    return not_null_count(event_log(table(spark, sf_dir, "events")), "properties.action.hospital")


# -- extremes ---------------------------------------------------------------


def _orders_as_readings(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))


def largest_order(spark, sf_dir):
    return largest(_orders_as_readings(spark, sf_dir), "o_totalprice",
                   ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"])


def _lines_with_net_price(spark, sf_dir):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, sf_dir, "lineitem").withColumn("net_price", net)


def extremes_of_lines(spark, sf_dir):
    return extremes_report(_lines_with_net_price(spark, sf_dir), _LINE_STATS, _LINE_KEYS,
                           sentinels=[50.0], overrides={"l_tax": [0.08]})


def extremes_from_csv(spark, sf_dir):
    path = scratch_path(spark, "readings")
    orders = _orders_as_readings(spark, sf_dir)
    write_table(orders, path, "csv", options={"header": "true"})
    readings = read_readings(spark, path, orders.schema)
    report = extremes_report(
        readings, [("Highest order", "o_totalprice", "USD"), ("Highest customer", "o_custkey", "")],
        ["o_orderkey", "o_orderpriority"])
    return with_text(report, "%s: order %d (%s)",
                     ["description", "o_orderkey", "o_orderpriority"])


# -- reconciliation ---------------------------------------------------------


def reconcile_events(spark, sf_dir):
    path = scratch_path(spark, "reconcile")
    flat = flatten_event(event_log(table(spark, sf_dir, "events")))
    write_table(flat, path, "json")
    written = read_back(spark, path, flat.schema, "json")
    return metric_lines(reconcile(flat, written, "messageId", extra=True))


def reconcile_sessions(spark, sf_dir):
    """Sessions are computed once: their source counts are taken while they are written."""
    return write_reconciled(sessions_30m(spark, sf_dir), scratch_path(spark, "reconcile-sessions"), "session_id")


def malformed_lines(spark, sf_dir):
    """Counts of a log in which every event with ``k`` a multiple of 10 is cut off."""
    path = scratch_path(spark, "malformed")
    log = event_log(table(spark, sf_dir, "events"))
    text = F.to_json(F.struct("*"))
    broken = F.col("hospitalId").cast("bigint") % 10 == 0
    write_table(log.select(F.when(broken, F.substring(text, 1, 40)).otherwise(text).alias("value")), path, "text")
    return count_metrics(read_events(spark, path, event_schema(corrupt=True)), "messageId", "DL", extra=True)


def rejected_lines(spark, sf_dir):
    """Good rows and malformed lines of a log in which every event with ``k`` a multiple of 10 is cut off."""
    source, target, metrics = (scratch_path(spark, f"rejects-{part}") for part in ("in", "out", "metrics"))
    text = F.to_json(F.struct("*"))
    broken = F.col("hospitalId").cast("bigint") % 10 == 0
    log = event_log(table(spark, sf_dir, "events"))
    write_table(log.select(F.when(broken, F.substring(text, 1, 40)).otherwise(text).alias("value")), source, "text")
    counted = daily_load(spark, source, target, metrics, fmt="parquet", rejects=True)
    schema = flatten_event(spark.createDataFrame([], event_schema())).schema
    good, bad = read_accepted(spark, target, schema), read_rejects(spark, target)
    n_corrupt = counted.where("metric = 'DL_corrupt_count'").select(F.lit("counted").alias("part"), F.col("value").cast("string").alias("content"))
    return (good.select(F.lit("accepted").alias("part"), F.col("messageId").alias("content"))
            .unionByName(bad.select(F.lit("rejected").alias("part"), F.col("text").alias("content"))).unionByName(n_corrupt))


def persisted_counts(spark, sf_dir):
    """Two actions over one parsed log: its lines and its users."""
    with persisted(read_events(spark, _json_log(spark, sf_dir, "persisted"))) as log:
        n_events = log.count()
        n_users = log.select("anonymousId").distinct().count()
    return spark.createDataFrame([(n_events, n_users)], "n_events BIGINT, n_users BIGINT")


def compare_users(spark, sf_dir):
    """Side by side with a key that repeats, and one row count taken while writing."""
    path = scratch_path(spark, "compare")
    events = table(spark, sf_dir, "events").select("user_id", "event_type")
    counted = write_counted(events, path)
    return compare(events, read_back(spark, path, events.schema, "parquet"), "user_id").withColumn(
        "rows_seen_by_write", F.lit(counted).cast("bigint"))


def compare_event_contents(spark, sf_dir):
    """Keys that differ between the log and a written copy in which some events were dropped,
    changed or added."""
    path = scratch_path(spark, "contents")
    flat = flatten_event(event_log(table(spark, sf_dir, "events")))
    k = F.col("properties_properties_hospitalid").cast("bigint")
    event = F.when(k % 89 == 1, F.concat("event", F.lit("!"))).otherwise(F.col("event"))
    kept = flat.where(k % 97 != 0).withColumn("event", event)
    added = flat.where(k % 83 == 2).withColumn("messageId", F.concat(F.lit("x-"), "messageId"))
    write_table(kept.unionByName(added), path)
    return compare_contents(flat, read_back(spark, path, flat.schema, "parquet"), "messageId")


def daily_metrics_history(spark, sf_dir):
    """Events of each type and day against the seven days before."""
    daily = table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("value"))
    return against_history(daily, ["event_type"], share=0.25)


def daily_load_metrics(spark, sf_dir):
    root = _day_folders(spark, sf_dir, "daily-in")
    return daily_load(spark, root, scratch_path(spark, "daily-out"),
                      scratch_path(spark, "daily-metrics"), pattern="*/*")


# -- round trips ------------------------------------------------------------


def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    suppliers = table(spark, sf_dir, "supplier")
    write_table(suppliers, path, "csv", options={"header": "true"})
    return read_readings(spark, path, suppliers.schema)


def gzip_json_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "gzip")
    customers = table(spark, sf_dir, "customer")
    write_table(customers, path, "json", options={"compression": "gzip"})
    return read_events(spark, path, customers.schema, partitions=8)


def distinct_types(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_type").distinct()


# -- days and files ---------------------------------------------------------


def day_volume(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.groupBy(day_ms(events, "ts").alias("day_ms")).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.round(F.sum(F.length("props")) / 1024, 2).alias("props_kb"),
    ).withColumn("next_day_ms", next_day(F.col("day_ms")))


def missing_user_days(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    days = events.select("user_id", day_ms(events, "ts").alias("day_ms"))
    first, last = (days.agg(edge("day_ms")).scalar() for edge in (F.min, F.max))
    return missing_days(days, ["user_id"], first=first, last=last)


def missing_user_ranges(spark, sf_dir):
    """Runs of days without an event, for each user, from the first to the last day of all."""
    events = table(spark, sf_dir, "events")
    days = events.select("user_id", day_ms(events, "ts").alias("day_ms"))
    first, last = (days.agg(edge("day_ms")).scalar() for edge in (F.min, F.max))
    return missing_ranges(days, ["user_id"], first=first, last=last)


def day_folder_status(spark, sf_dir):
    """Status of every day from the first folder to one day past the last."""
    root = _delivered_twice(spark, sf_dir, "status")
    folders = folder_volume(file_inventory(spark, root, "*.json", hidden=False), root, level=2)
    return day_status(folders, last=next_day(F.max("day_ms")))


def event_folder_names(spark, sf_dir):
    root = _delivered_twice(spark, sf_dir, "folders")
    files = file_inventory(spark, root, "*.json", hidden=False)
    levels = [folder_names(files, root, n).select(F.lit(n).alias("level"), "folder") for n in (1, 2)]
    return levels[0].unionByName(levels[1])


def inventory_total(spark, sf_dir):
    """Files and kilobytes of the day folders of each source."""
    root = _delivered_twice(spark, sf_dir, "total")
    files = file_inventory(spark, root, "*.json", hidden=False)
    return volume(files.withColumn("source", F.split(relative_path(root), "/")[0]), "source")


def last_day_files(spark, sf_dir):
    """Folder and size of the five last files by path."""
    root = _delivered_twice(spark, sf_dir, "last")
    files = last_files(file_inventory(spark, root, "*.json", hidden=False))
    return files.select(F.regexp_extract(relative_path(root), "^(.*)/", 1).alias("folder"), "length")


def events_of_days(spark, sf_dir):
    """Two ways to read some days of a log: by their folders, and by a folder filter."""
    root = _day_folders(spark, sf_dir, "days")
    days = [1704067200000 + d * 86_400_000 for d in (2, 3, 9)]
    by_path = read_events(spark, day_paths(root, [f"day_ms={day}" for day in days]))
    by_filter = read_events(spark, root).filter(F.col("day_ms").isin(days))
    return by_path.select(F.lit("folders").alias("way"), "messageId").unionByName(
        by_filter.select(F.lit("filter").alias("way"), "messageId"))


def metric_file_preview(spark, sf_dir):
    """Daily counts stored as one metric file per event type; the first rows of each."""
    path = scratch_path(spark, "metrics")
    events = table(spark, sf_dir, "events")
    daily = events.groupBy("event_type", F.to_date("ts").cast("string").alias("metric")).agg(
        F.count(F.lit(1)).alias("value"))
    # One row per type and day: small by construction, so one file per type is fine.
    (daily.repartition("event_type").sortWithinPartitions("event_type", "metric")
     .write.partitionBy("event_type").json(path))
    preview = metric_preview(spark, path, schema=METRIC_SCHEMA)
    return preview.select(
        F.regexp_extract("file_path", r"event_type=([^/]+)/", 1).alias("event_type"),
        F.col("row_in_file").cast("bigint").alias("row_in_file"), "metric", "value")


# -- streaming --------------------------------------------------------------


def ingest_daily_stream(spark, sf_dir):
    """Two deliveries of day folders, odd days first, into one target and checkpoint."""
    source, target, metrics, checkpoint = (
        scratch_path(spark, f"ingest-{part}") for part in ("in", "out", "metrics", "state"))
    log = day_log(table(spark, sf_dir, "events"))
    is_odd = F.col("day_ms") / 86_400_000 % 2 == 1
    for delivery in (log.filter(is_odd), log.filter(~is_odd)):
        write_table(delivery, source, "json", mode="append",
                    partition_by=["source", "day_ms"], rebalance=True)
        ingest_available(spark, f"{source}/*/*", target, metrics, checkpoint)
    return read_ingested(spark, target).groupBy("ymd").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_distinct("messageId").alias("n_messages"),
        F.min("timestamp").alias("first_local"), F.max("timestamp").alias("last_local"))


def ingested_file_status(spark, sf_dir):
    """Odd days are loaded, even days delivered after it: what the ledger says of each day's files."""
    source, target, metrics, checkpoint = (
        scratch_path(spark, f"status-{part}") for part in ("in", "out", "metrics", "state"))
    log = day_log(table(spark, sf_dir, "events"))
    is_odd = F.col("day_ms") / 86_400_000 % 2 == 1
    write_table(log.where(is_odd), source, "json", mode="append", partition_by=["source", "day_ms"], rebalance=True)
    ingest_available(spark, f"{source}/*/*", target, metrics, checkpoint)
    write_table(log.where(~is_odd), source, "json", mode="append", partition_by=["source", "day_ms"], rebalance=True)
    files = file_inventory(spark, source, "*.json", hidden=False)
    known = file_status(files, read_ledger(spark, ledger_of(target)))
    return known.select(day_of(F.regexp_extract("path", "/(day_ms=[0-9]+)/", 1)).alias("day_ms"), "status").distinct()


def stream_user_sessions(spark, sf_dir):
    """``events`` as a stream; a later delivery of one far-future event closes the rest."""
    source, target, checkpoint = (
        scratch_path(spark, f"live-{part}") for part in ("in", "out", "state"))
    events = table(spark, sf_dir, "events").select("user_id", "ts")
    closing = events.agg(
        F.lit(-1).cast("bigint").alias("user_id"),
        (F.max("ts") + F.expr("INTERVAL 10 YEARS")).alias("ts"))
    for delivery in (events, closing):
        write_table(delivery, source, mode="append")
        stream = file_stream(spark, events.schema).parquet(source)
        write_available(stream_sessions(stream, "user_id", "ts"), target, checkpoint)
    return spark.read.parquet(target).filter("user_id >= 0")


QUERIES = {query.__name__: query for query in (
    sessions_30m, sessions_6h, sessions_of_types, sessions_all_events, sessions_from_log, sessions_by_load,
    calendar_keys, calendar_keys_iso_local, calendar_keys_orders,
    flatten_events, safe_columns, array_elements, auto_flatten, inferred_log, case_tolerant_log,
    log_of_spellings, event_hospital_rows, lines_of_nested_orders,
    nested_sql_top5, not_null_hospitals,
    largest_order, extremes_of_lines, extremes_from_csv,
    reconcile_events, reconcile_sessions, malformed_lines, rejected_lines, persisted_counts, compare_users,
    compare_event_contents, daily_load_metrics, daily_metrics_history,
    csv_roundtrip, gzip_json_roundtrip, distinct_types,
    day_volume, missing_user_days, missing_user_ranges, day_folder_status, event_folder_names, inventory_total,
    last_day_files, events_of_days, metric_file_preview,
    ingest_daily_stream, ingested_file_status, stream_user_sessions,
)}
