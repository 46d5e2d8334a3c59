"""Every registered query against its DuckDB SQL."""

from __future__ import annotations

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry

# The corpus queries, whose package may be absent, have tests of their own.
QUERIES = {
    name: query
    for name, query in entry.queries().items()
    if not re.match(r"op\d+_|pipeline$", name)
}
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, sf_dir, duck, name):
    got = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(got.columns) == sorted(columns)
    rows = [tuple(r) for r in got.collect()]
    assert rows
    assert _sorted_rows(got.columns, rows) == _sorted_rows(columns, result.fetchall())


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "Index Flag" in df.columns


def test_planted_defects_show(spark, sf_dir):
    """Each status occurs, so agreement is not agreement on a constant."""
    back = QUERIES["back_data_check"](spark, sf_dir).collect()
    assert {r["Item Count Flag"] for r in back} == {"PASS", "INVESTIGATE", "FAIL"}
    cover = QUERIES["coverage_check"](spark, sf_dir).collect()
    assert {r["ITEM COUNT FLAG"] for r in cover} == {"PASS", "FAIL"}
    keys = QUERIES["back_data_missing_keys"](spark, sf_dir).collect()
    assert {r["key_status"] for r in keys} == {"both", "new"}
