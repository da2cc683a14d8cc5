"""Nested records: reading, flattening, tolerant access."""

import gzip
import json

import pytest
from pyspark.sql import types as T

from clickloom.functions.calendar import cast_columns
from clickloom.functions.paths import leaf_paths, resolve, safe_col
from clickloom.operators.flatten import add_safe_columns, event_view, flatten, flatten_event
from clickloom.operators.reconcile import not_null_count
from clickloom.schemas import EVENT_COLUMNS, EVENT_SQL_COLUMNS, TIME_COLUMNS, event_schema
from clickloom.sources.events import (
    day_paths, infer_schema, join_path, load_schema, persisted, read_events,
    read_events_any_case, save_schema)

FULL = {
    "anonymousId": "u", "messageId": "m1", "hospitalId": "h", "event": "click",
    "timestamp": "2024-01-01T20:00:00Z", "type": "track", "userId": "7",
    "context": {"userAgent": "ua", "ip": "1.2.3.4", "locale": "ko", "page": {"url": "/x"}},
    "properties": {
        "path": "/p", "page": "pg",
        "button": {"name": "b", "hospital": ["5"]},
        "action": {"name": "a", "hospital": [1, "H"]},
        "properties": {"hospitalId": "9", "pageName": "pn", "routeName": "rn", "to": "t"}},
}
LINES = [
    json.dumps(FULL),
    json.dumps({**FULL, "messageId": "m2", "properties": {"action": {"hospital": []}}}),
    json.dumps({k: v for k, v in {**FULL, "messageId": "m3"}.items() if k != "properties"}),
    json.dumps({**FULL, "messageId": "m4", "timestamp": "soon"}),
    "{not json",
    "{}",
]


@pytest.fixture
def log(tmp_path):
    folder = tmp_path / "src" / "1704067200000"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text("\n".join(LINES[:3]))
    with gzip.open(folder / "b.json.gz", "wt") as out:
        out.write("\n".join(LINES[3:]))
    return str(tmp_path)


def test_fixed_schema_reads_plain_and_gzip_and_counts_bad_lines(spark, log):
    events = read_events(spark, join_path(log + "/", "/*/*"), partitions=3)
    rows = events.collect()
    assert len(rows) == 6
    bad = [r for r in rows if r._corrupt_record is not None]
    assert [r._corrupt_record for r in bad] == ["{not json"]
    assert all(bad[0][c] is None for c in events.columns if c != "_corrupt_record")


def test_wrong_types_keep_the_row_and_its_other_fields(spark, tmp_path):
    (tmp_path / "x.json").write_text(
        '{"messageId":"m5","properties":{"path":"/p","action":{"hospital":"no list"}}}\n'
        '{"messageId":6,"properties":"text","userId":7}\n')
    rows = {r.messageId: r for r in flatten_event(read_events(spark, str(tmp_path))).collect()}
    assert rows["m5"].properties_action_hospital_id is None and rows["m5"].properties_path == "/p"
    assert rows["6"].properties is None and rows["6"].userId == "7"


def test_day_folders_are_selected_by_path(spark, log):
    here = read_events(spark, day_paths(log, [1704067200000]))
    assert here.count() == 6
    assert day_paths("/r/", [1, 2], "s") == ["/r/s/1", "/r/s/2"]


def test_flattened_event_has_the_28_columns_in_order(spark, log):
    flat = flatten_event(read_events(spark, f"{log}/*/*"))
    assert flat.columns == [alias for alias, _ in EVENT_COLUMNS]
    assert len(flat.columns) == 28
    rows = {r.messageId: r for r in flat.collect() if r.messageId}
    full = rows["m1"]
    assert (full.properties_action_hospital_id, full.properties_action_hospital_name) == ("1", "H")
    assert (full.properties_button_hospital_num, full.properties_button_hospital_name) == ("5", None)
    assert full.properties_properties_hospitalid == "9"
    assert str(full.timestamp) == "2024-01-02 05:00:00"
    assert full.ymd == "2024-01-01"
    assert rows["m2"].properties_action_hospital_id is None
    assert rows["m3"].properties is None and rows["m3"].properties_path is None
    assert rows["m4"].timestamp is None and rows["m4"].yw is None


def test_json_keys_are_matched_by_case_unless_asked_otherwise(spark, tmp_path):
    lower = {"anonymousid": "v", "messageid": "m9",
             "context": {"useragent": "ua2", "page": {"url": "/y"}},
             "properties": {"action": {"hospital": [3, "Z"]}, "properties": {"hospitalid": "4"}}}
    (tmp_path / "x.json").write_text("\n".join([json.dumps(FULL), json.dumps(lower), "", "[broken"]))
    strict = read_events(spark, str(tmp_path))
    assert {r.anonymousId for r in strict.collect()} == {"u", None}
    loose = read_events_any_case(spark, str(tmp_path))
    assert loose.columns == event_schema().names
    rows = {r.messageId: r for r in loose.collect()}
    assert rows["m9"].anonymousId == "v"
    assert rows["m9"].context.userAgent == "ua2"
    assert rows["m9"].properties.action.hospital == ["3", "Z"]
    assert rows["m9"].properties.button is None
    assert rows["m1"].properties == [r for r in strict.collect() if r.messageId == "m1"][0].properties
    assert rows[None]._corrupt_record == "[broken" and rows[None].context is None
    assert flatten_event(loose).count() == 3


def test_inferred_schema_can_be_kept(spark, log, tmp_path):
    schema = infer_schema(spark, f"{log}/src/*/a.json")
    save_schema(spark, schema, str(tmp_path / "schema"))
    assert load_schema(spark, str(tmp_path / "schema")) == schema
    assert resolve(schema, "properties.action.hospital").dtype == T.ArrayType(T.StringType())


SAMPLE = """id STRING, text STRUCT<a: STRUCT<x: STRING, y: STRING>, b: STRING, c: STRUCT<z: STRING>, d: STRING>,
    ent STRING, mesd STRING,
    pop STRUCT<cat: STRING, pat: STRING, pop: STRUCT<inner: STRUCT<sot: STRING>, rel: STRING>, ref: STRING>,
    tray STRUCT<Id: STRING>, timestampAt STRING"""


def test_leaves_of_any_depth(spark):
    df = spark.createDataFrame([], SAMPLE)
    assert [".".join(names) for names, _ in leaf_paths(df.schema)] == [
        "id", "text.a.x", "text.a.y", "text.b", "text.c.z", "text.d", "ent", "mesd", "pop.cat",
        "pop.pat", "pop.pop.inner.sot", "pop.pop.rel", "pop.ref", "tray.Id", "timestampAt"]


def test_flatten_drops_parents_and_ignores_absent_names(spark):
    flat = flatten(spark.createDataFrame([], SAMPLE), drop=["tray", "_metadata"])
    assert "pop_pop_inner_sot" in flat.columns and "tray_Id" not in flat.columns
    assert cast_columns(flat, TIME_COLUMNS).schema["timestampAt"].dataType == T.TimestampType()
    assert flatten(spark.createDataFrame([], SAMPLE), sep=".").columns[1] == "text.a.x"
    with pytest.raises(ValueError):
        flatten(spark.createDataFrame([], "a STRUCT<b: STRING>, a_b STRING"))


def test_fields_with_dots_and_backticks(spark):
    df = spark.createDataFrame([(("v",),)], T.StructType().add(
        "a.b", T.StructType().add("c`d", "string")))
    assert flatten(df).columns == ["a.b_c`d"]
    assert flatten(df).first()[0] == "v"


def test_absent_paths_are_typed_nulls(spark):
    df = spark.createDataFrame([((["x"], "s"),)], "a STRUCT<l: ARRAY<STRING>, s: STRING>")
    out = add_safe_columns(df, {
        "there": "a.l[0]", "beyond": "a.l[3]", "no_list": "a.s[0]", "below_text": "a.s.deeper",
        "none": "q.w", "number": ("q.w", "bigint"), "upper": "A.S"})
    row = out.first()
    assert (row.there, row.beyond, row.no_list, row.below_text, row.none, row.number, row.upper) == (
        "x", None, None, None, None, None, "s")
    assert out.schema["none"].dataType == T.StringType()
    assert out.schema["number"].dataType == T.LongType()
    assert safe_col(df.schema, "nothing") is not None


def test_exact_spelling_wins_over_other_case(spark):
    schema = T.StructType().add("Id", "string").add("id", "long")
    assert resolve(schema, "id").dtype == T.LongType()
    assert resolve(schema, "Id").dtype == T.StringType()
    assert resolve(schema, "ID").dtype == T.StringType()


def test_sql_view_and_not_null_count(spark, log):
    events = read_events(spark, f"{log}/*/*")
    with persisted(events):
        query = event_view(events)
        top = spark.sql(f"{query} WHERE properties.action.hospital IS NOT NULL "
                        "ORDER BY messageid LIMIT 5;")
        assert top.columns == [alias for alias, _ in EVENT_SQL_COLUMNS] and len(top.columns) == 21
        assert [r.messageid for r in top.collect()] == ["m1", "m2", "m4"]
        assert not_null_count(events, "properties.action.hospital").first().n == 3
    assert not events.is_cached


def test_declared_type_holds_for_found_and_absent_paths(spark):
    df = spark.createDataFrame([("7",), ("x",)], "v STRING")
    out = add_safe_columns(df, {"n": ("v", "bigint"), "m": ("none", "bigint"), "t": "v"})
    assert dict(out.dtypes) == {"v": "string", "n": "bigint", "m": "bigint", "t": "string"}
    assert [r.n for r in out.collect()] == [7, None]
