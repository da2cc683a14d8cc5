"""Every registered query against its SQL over the same Parquet files."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

# Spark type -> DuckDB type
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
         "float": "FLOAT", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def canonical(rows):
    return sorted(tuple("∅" if v is None else repr(v) for v in row) for row in rows)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for file in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(file))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{file}')")
    return con


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, sf_dir, name):
    got = queries()[name](spark, sf_dir)
    result = duck.execute(oracle_sql()[name])
    wanted_types = {d[0]: str(d[1]) for d in result.description}
    wanted = result.fetchall()
    names = sorted(got.columns)
    assert names == sorted(wanted_types)
    assert {n: TYPES[t] for n, t in got.dtypes} == wanted_types
    position = {n: i for i, n in enumerate(wanted_types)}
    assert wanted
    assert canonical(tuple(r) for r in got.select(*[f"`{n}`" for n in names]).collect()) == canonical(
        tuple(row[position[n]] for n in names) for row in wanted)


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    assert queries()[name](spark, sf_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
