"""Missing days as ranges; logs with keys in several spellings."""

import json
import random

from pyspark.sql import functions as F

from clickloom.operators.days import missing_days
from clickloom.operators.gaps import days_of_ranges, missing_ranges
from clickloom.schemas import CORRUPT, event_schema
from clickloom.sources.events import read_events
from clickloom.sources.spellings import folded, infer_spellings, read_spelled

DAY = 86_400_000


def test_ranges_against_plain_sets(spark):
    rng = random.Random(2)
    rows = [(rng.choice("abc"), rng.randrange(-20, 40) * DAY) for _ in range(60)] + [("d", None), (None, 3 * DAY), (None, 6 * DAY)]
    df = spark.createDataFrame(rows, "k string, day_ms bigint")
    for first, last in ((None, None), (-5 * DAY, 30 * DAY), (7 * DAY + 1, 9 * DAY + 5), (9 * DAY, 8 * DAY)):
        wanted = set()
        for key in {k for k, _ in rows}:
            days = {d for k, d in rows if k == key and d is not None}
            low = min(days, default=None) if first is None else first
            high = max(days, default=None) if last is None else last
            if low is not None and high is not None:
                wanted |= {(key, d) for d in range(-(-low // DAY) * DAY, high + 1, DAY) if d not in days}
        got = [tuple(r) for r in missing_days(df, ["k"], first=first, last=last).collect()]
        assert len(got) == len(set(got)) and set(got) == wanted
        ranges = missing_ranges(df, ["k"], first=first, last=last).collect()
        assert sum(r.n_days for r in ranges) == len(wanted)
        assert all(r.n_days == (r.last_missing - r.first_missing) // DAY + 1 for r in ranges)


def test_a_stray_day_costs_one_row(spark):
    year_9999 = 253_370_764_800_000
    df = spark.createDataFrame([(0,), (DAY,), (year_9999,)], "day_ms bigint")
    ranges = missing_ranges(df)
    assert [tuple(r) for r in ranges.collect()] == [(2 * DAY, year_9999 - DAY, year_9999 // DAY - 2)]
    assert days_of_ranges(ranges).agg(F.count("*"), F.count_distinct("day_ms")).first() == (year_9999 // DAY - 2,) * 2
    assert missing_ranges(df.limit(0)).count() == 0


def test_spellings_read_like_the_fixed_schema(spark, tmp_path):
    rows = [{"anonymousId": f"u{k}", "messageId": f"m{k}", "context": {"userAgent": f"a{k}", "page": {"url": f"/{k}"}},
             "properties": {"action": {"hospital": [str(k), "x"]}}} for k in range(6)]
    plain = tmp_path / "plain"
    plain.mkdir()
    (plain / "a.json").write_text("\n".join(map(json.dumps, rows)))
    lines = []
    for k, row in enumerate(rows):
        text = json.dumps(row)
        text = [text, text.replace("anonymousId", "anonymousid").replace("userAgent", "useragent"),
                text.replace("anonymousId", "AnonymousID").replace('"context"', '"Context"').replace('"url"', '"URL"')][k % 3]
        lines.append(text.replace('{"anon', '{"messageId": "first", "anon', 1) if k == 3 else text)
    mixed = tmp_path / "mixed"
    mixed.mkdir()
    (mixed / "a.json").write_text("\n".join(lines) + "\n\n")
    fixed = event_schema(corrupt=False)
    found = infer_spellings(spark, str(mixed))
    names = {f.name for f in found.fields}
    assert {"anonymousId", "anonymousid", "AnonymousID", "context", "Context"} <= names
    got = read_spelled(spark, str(mixed), found, fixed)
    wanted = read_events(spark, str(plain), fixed)
    assert sorted(map(repr, got.drop(CORRUPT).collect())) == sorted(map(repr, wanted.collect()))
    assert got.where(F.col(CORRUPT).isNotNull()).count() == 0
    own = folded(found)
    assert len({f.name.lower() for f in own.fields}) == len(own.fields)
    assert read_spelled(spark, str(mixed)).where("AnonymousID IS NULL OR Context.page.URL IS NULL").count() == 0


def test_no_value_is_lost_in_silence(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    lines = ['{"a": 1, "b": {"c": "x"}}', '{"A": "word", "b": null}', '{"a": 2, "b": 5}', "[1]", "broken", '"text"', "{}"]
    (log / "a.json").write_text("\n".join(lines))
    schema = "a BIGINT, b STRUCT<c: STRING>"
    from pyspark.sql import types as T
    got = {(r.a, r.b.c if r.b else None, r[CORRUPT]) for r in read_spelled(
        spark, str(log), schema=T.StructType.fromDDL(schema)).collect()}
    assert got == {(1, "x", None), (None, None, lines[1]), (2, None, lines[2]), (None, None, "[1]"),
                   (None, None, "broken"), (None, None, '"text"'), (None, None, None)}
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "a.json").write_text("\n")
    assert read_spelled(spark, str(empty)).columns == [CORRUPT]
