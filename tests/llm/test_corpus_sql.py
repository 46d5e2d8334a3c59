"""Every corpus query that SQL expresses against its DuckDB SQL, on the test tables."""

from __future__ import annotations

import duckdb
import pytest

from shelfaudit.llm import queries as corpus

ORACLE = corpus.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(ORACLE))
def test_corpus_query_equals_sql(spark, sf_dir, duck, name):
    result = duck.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    expected = sorted(result.fetchall(), key=repr)
    got = corpus.queries()[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(columns)
    assert expected and sorted(map(tuple, got.select(*columns).collect()), key=repr) == expected
