"""The inventory queries against a plain listing of the folders that they read."""

import os
from collections import defaultdict

import pytest

from clickloom.plans import queries

DAY = 86_400_000


@pytest.fixture()
def listed(monkeypatch):
    """The files below each root that a query has written, as (relative path, length)."""
    roots = []
    inner = queries._delivered_twice

    def remember(*args):
        roots.append(inner(*args))
        return roots[-1]

    def files():
        found = []
        for folder, _, names in os.walk(roots[-1].removeprefix("file:")):
            for name in names:
                if name.endswith(".json"):
                    path = os.path.join(folder, name)
                    found.append((os.path.relpath(path, roots[-1].removeprefix("file:")), os.path.getsize(path)))
        return found

    monkeypatch.setattr(queries, "_delivered_twice", remember)
    return files


def sizes(files, key):
    groups = defaultdict(list)
    for path, length in files:
        groups[key(path)].append(length)
    return {k: (len(v), pytest.approx(sum(v) / 1024, abs=0.0051)) for k, v in groups.items()}


def test_total_of_each_source(spark, sf_dir, listed):
    got = {r.source: (r.n_files, r.size_kb) for r in queries.inventory_total(spark, sf_dir).collect()}
    files = listed()
    assert got == sizes(files, lambda path: path.split("/")[0])
    folders = {os.path.dirname(path) for path, _ in files}
    assert len(files) > len(folders)  # several files in a folder


def test_status_of_each_day(spark, sf_dir, listed):
    got = {r.day_ms: r for r in queries.day_folder_status(spark, sf_dir).collect()}
    wanted = sizes(listed(), lambda path: int(path.split("day_ms=")[1].split("/")[0]))
    assert {d: (r.n_files, r.size_kb) for d, r in got.items() if r.status == "loaded"} == wanted
    assert set(got) == set(range(min(wanted), max(wanted) + 2 * DAY, DAY))
    assert got[max(wanted) + DAY].line == f"{max(wanted) + DAY}: 0 files, 0.0 KB, empty"


def test_last_files(spark, sf_dir, listed):
    got = [(r.folder, r.length) for r in queries.last_day_files(spark, sf_dir).collect()]
    last = sorted(listed(), reverse=True)[:5]
    assert got == [(os.path.dirname(path), length) for path, length in last]
