"""File inventory and day completeness."""

import pytest
from pyspark.sql import functions as F

from clickloom.operators.days import day_status, missing_days, next_day
from clickloom.sources.files import (
    file_inventory, folder_names, folder_volume, last_files, odd_folders, relative_path, volume)

DAY = 86_400_000
FIRST, LAST = 1652313600000, 1664755200000


@pytest.fixture
def root(tmp_path):
    """Two sources; the second day of ``s1`` is missing, its fourth folder is empty."""
    base = tmp_path / "segment logs"
    for source, days in (("s1", (0, 2)), ("s2", (0, 1, 2))):
        for d in days:
            folder = base / source / str(FIRST + d * DAY)
            folder.mkdir(parents=True)
            (folder / "a.json").write_text("x" * 1000)
            (folder / "b.json.gz").write_text("y" * 500)
    (base / "s1" / str(FIRST + 3 * DAY)).mkdir()
    return str(base)


def test_inventory_and_volume(spark, root):
    files = file_inventory(spark, root)
    assert files.columns == ["path", "length", "modificationTime"]
    assert tuple(volume(files).first()) == (10, round(7500 / 1024, 2))
    assert tuple(volume(file_inventory(spark, root, "*.json")).first()) == (5, round(5000 / 1024, 2))


def test_missing_or_empty_folder_is_an_empty_inventory(spark, root):
    for path in (root + "/absent", f"{root}/s1/{FIRST + 3 * DAY}"):
        files = file_inventory(spark, path)
        assert files.isEmpty()
        assert tuple(volume(files).first()) == (0, 0.0)


@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
def test_folders_by_level(spark, root, prefix):
    files = file_inventory(spark, root)
    assert {r.folder for r in folder_names(files, prefix + root).collect()} == {"s1", "s2"}
    assert {r.folder for r in folder_names(files, prefix + root + "/", 2).collect()} == {
        str(FIRST + d * DAY) for d in range(3)}
    assert folder_names(files, prefix + root, 3).isEmpty()
    assert files.select(relative_path(prefix + root)).distinct().count() == 10


def test_last_files(spark, root):
    names = [r.path for r in last_files(file_inventory(spark, root), 3).collect()]
    assert names == sorted(names, reverse=True) and len(names) == 3
    assert names[0].endswith(f"s2/{FIRST + 2 * DAY}/b.json.gz")


def test_status_of_every_expected_day(spark, root):
    folders = folder_volume(file_inventory(spark, root), root, level=2)
    got = day_status(folders, last=next_day(F.max("day_ms"))).orderBy("day_ms").collect()
    assert [(r.day_ms, r.n_files, r.status) for r in got] == [
        (FIRST, 4, "loaded"), (FIRST + DAY, 2, "loaded"), (FIRST + 2 * DAY, 4, "loaded"),
        (FIRST + 3 * DAY, 0, "empty")]
    assert got[1].line == f"{FIRST + DAY}: 2 files, 1.46 KB, loaded"


def test_missing_days_per_key_and_within_given_bounds(spark, root):
    s1 = f"{root}/s1"
    folders = folder_volume(file_inventory(spark, s1), s1)
    assert [r.day_ms for r in missing_days(folders).collect()] == [FIRST + DAY]
    wide = missing_days(folders, first=FIRST - DAY, last=FIRST + 3 * DAY)
    assert sorted(r.day_ms for r in wide.collect()) == [FIRST - DAY, FIRST + DAY, FIRST + 3 * DAY]
    assert missing_days(folders, first=FIRST, last=FIRST - DAY).isEmpty()
    keyed = spark.createDataFrame(
        [("a", FIRST), ("a", FIRST + 2 * DAY), ("b", FIRST), ("b", None)] + [("a", FIRST)] * 5,
        "k STRING, day_ms BIGINT")
    assert [tuple(r) for r in missing_days(keyed, ["k"]).collect()] == [("a", FIRST + DAY)]


def test_145_contiguous_days(spark):
    days = spark.range(145).select((F.lit(FIRST) + F.col("id") * DAY).alias("day_ms"))
    assert days.agg(F.max("day_ms")).first()[0] == LAST
    assert missing_days(days).isEmpty()
    assert missing_days(days.filter(F.col("day_ms") != LAST), last=LAST).first().day_ms == LAST


def test_inventory_holds_files_of_any_name_and_size(spark, tmp_path, monkeypatch):
    import os
    day = tmp_path / "log" / str(FIRST)
    day.mkdir(parents=True)
    for name, text in (("a.json", "xx"), ("empty.json", ""), ("_SUCCESS", ""), ("_x.json", "y"), (".h.json", "z")):
        (day / name).write_text(text)
    only_empty = tmp_path / "log" / str(FIRST + DAY)
    only_empty.mkdir()
    (only_empty / "e.gz").write_text("")
    (tmp_path / "log" / "_tmp").mkdir()
    (tmp_path / "log" / "_tmp" / "b.json").write_text("b")
    root = str(tmp_path / "log")
    walked = {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(root) for f in files}
    got = {r.path.removeprefix("file:"): r.length for r in file_inventory(spark, root).collect()}
    assert got == walked
    assert file_inventory(spark, root, hidden=False).count() == 3
    assert file_inventory(spark, root, "*.json").count() == 5
    counts = {r.day_ms: r.n_files for r in folder_volume(file_inventory(spark, root), root).collect()}
    assert counts == {FIRST: 5, FIRST + DAY: 1}


def test_roots_in_any_spelling_and_foreign_paths(spark, root):
    files = file_inventory(spark, root)
    for spelled in (root.replace("/segment", "//segment"), root + "//", "file://" + root):
        assert {r.folder for r in folder_names(files, spelled).collect()} == {"s1", "s2"}
    for foreign in (root + "/s1", root + "/s*", "segment logs"):
        with pytest.raises(Exception, match="not below"):
            folder_names(files, foreign).collect()


def test_only_midnights_are_days(spark):
    names = [str(FIRST), f"day_ms={FIRST + DAY}", "backup_2", "2", str(FIRST + 1), "2024"]
    files = spark.createDataFrame([(f"/r/{n}/a", 1, None) for n in names], "path STRING, length BIGINT, m STRING")
    assert sorted(r.day_ms for r in folder_volume(files, "/r").collect()) == [FIRST, FIRST + DAY]
    assert {r.folder for r in odd_folders(files, "/r").collect()} == set(names[2:])
    with pytest.raises(Exception, match="no midnight"):
        missing_days(spark.createDataFrame([(FIRST + 2,)], "day_ms BIGINT")).collect()


def test_keys_without_a_day_and_bounds_off_midnight(spark):
    keyed = spark.createDataFrame([("a", FIRST), ("c", None)], "k STRING, day_ms BIGINT")
    got = missing_days(keyed, ["k"], first=FIRST - 5, last=FIRST + DAY + 5).collect()
    assert sorted(map(tuple, got)) == [("a", FIRST + DAY), ("c", FIRST), ("c", FIRST + DAY)]
