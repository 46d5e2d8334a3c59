"""The plans must hold at scale, so their shape is tested too."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from shelfaudit import schema as S
from shelfaudit.config import QcConfig
from shelfaudit.operators import back_data, coverage, duplication, hygiene, index
from shelfaudit.operators.summary import items, slices
from shelfaudit.plans import suite
from shelfaudit.sources import fixtures
from shelfaudit.sources.store import Workspace
from shelfaudit.sources.tables import with_collation


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(df) -> list[str]:
    return re.findall(r"ReadSchema: struct<(.*?)>\n", _plan(df) + "\n")


@pytest.fixture(scope="module")
def tables(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    out = {}
    for name in ("raw_pricing", "pricing_current", "pricing_prior", "codes"):
        path = str(folder / name)
        getattr(fixtures, name)(spark, sf_dir).write.parquet(path)
        out[name] = spark.read.parquet(path)
    return out


def test_no_python_no_cross_join_no_row_copies(tables):
    raw, cur, prior = (tables[n] for n in ("raw_pricing", "pricing_current", "pricing_prior"))
    plans = [
        duplication.duplication_check(cur),
        coverage.coverage_check(raw, cur),
        back_data.back_data_check(prior, cur),
        index.store_index(cur),
        index.kvi_index(cur),
        slices(cur),
        items(cur),
        hygiene.char_profile(tables["codes"], "upc"),
        hygiene.char_profile_summary(tables["codes"], "upc"),
        hygiene.strip_chars(tables["codes"], "upc"),
    ]
    for df in plans:
        text = _plan(df)
        for bad in ("Python", "Cartesian", "NestedLoop", "Expand", "ObjectHashAggregate",
                    "SinglePartition, REPARTITION"):
            assert bad not in text, bad


def test_period_counts_copy_only_aggregated_rows(tables):
    """Two distinct counts copy rows, but only above the first aggregate."""
    lines = _plan(index.period_counts(tables["pricing_current"])).splitlines()
    (expand,) = [i for i, line in enumerate(lines) if "Expand [" in line]
    below = lines[expand + 1]
    assert "HashAggregate(keys=[time_period" in below and "market_name" in below


def test_narrow_scans(tables):
    cur = tables["pricing_current"]
    assert _scans(duplication.duplication_check(cur)) == [
        "market_name:string,time_period:string,upc:string,condition:string"
    ]
    assert _scans(items(cur)) == [
        "time_period:string,upc:string,condition:string,kvi_quad:string"
    ]
    assert len(_scans(slices(cur))) == 1
    text = _plan(back_data.back_data_missing_keys(tables["pricing_prior"], cur))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", text) == [
        "time_period:string,condition:string"
    ] * 2


def test_filters_reach_the_scan(tables):
    raw, cur = tables["raw_pricing"], tables["pricing_current"]
    text = _plan(coverage.coverage_check(raw, cur, QcConfig(focus_markets=("ASIA",))))
    pushed = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", text)
    assert len(pushed) == 2
    for scan in pushed:
        assert "EqualTo(market_name,ASIA)" in scan
        assert "GreaterThan(units,10" in scan
    text = _plan(index.kvi_index(cur))
    assert "EqualTo(kvi_quad,KVI)" in text and "Not(EqualTo(outlier_flag,Outlier))" in text


def test_hot_keys_are_combined_before_the_shuffle(tables):
    """Every exchange under an aggregate is fed by a partial aggregate."""
    cur = tables["pricing_current"]
    for df in (duplication.duplication_check(cur), slices(cur), items(cur),
               hygiene.char_profile(tables["codes"], "upc")):
        lines = _plan(df).splitlines()
        for i, line in enumerate(lines):
            if "Exchange" in line:
                assert "HashAggregate" in lines[i + 1]


def test_strip_moves_no_row(tables):
    assert "Exchange" not in _plan(hygiene.strip_chars(tables["codes"], "original_upc", "upc"))


def test_suite_scans_the_template_three_times(spark, tables, tmp_path, monkeypatch):
    """Keys, slices and items; every other report reads what these stored."""
    seen = []
    write = suite.Workspace.write

    def spy(self, df, name):
        files = _plan(df)
        seen.append((name, len(re.findall(r"FileScan parquet .*?/template\b", files))))
        return write(self, df, name)

    monkeypatch.setattr(suite.Workspace, "write", spy)
    suite.run_qc_suite(
        tables["raw_pricing"], tables["pricing_prior"], tables["pricing_current"],
        "qc_scan_count", folder=str(tmp_path),
    )
    scans = {name: n for name, n in seen if n}
    assert scans == {"current_slices": 1, "current_items": 1, "duplicate_keys": 1}


def test_reports_have_titles_for_every_column(tables):
    raw, cur, prior = (tables[n] for n in ("raw_pricing", "pricing_current", "pricing_prior"))
    reports = {
        "duplication": duplication.duplication_check(cur),
        "coverage": coverage.coverage_check(raw, cur),
        "back_data": back_data.back_data_check(prior, cur),
        "counts": index.period_counts(cur),
        "index": index.index_report(cur),
    }
    for name, df in reports.items():
        assert df.columns == list(S.TITLES[name]), name
    renamed = S.titled(reports["coverage"], "coverage", raw="Feed", template="Built")
    assert "Feed UPC Count" in renamed.columns and "Built ROM Units" in renamed.columns


def test_joined_test_data_leaves_hot_keys_to_be_split(spark, sf_dir):
    """With nothing small enough to broadcast, every skewable join feeds an
    exchange, so AQE may split its hot keys."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = _plan(fixtures.pricing_current(spark, sf_dir)).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    for key, above in (("l_partkey", "l_orderkey"), ("o_custkey", "o_orderkey"), ("l_orderkey", "mkt")):
        (join,) = [i for i, x in enumerate(lines) if f"SortMergeJoin [{key}#" in x]
        exchange = next(x for x in reversed(lines[:join]) if "Exchange" in x)
        assert f"hashpartitioning({above}#" in exchange


def test_collated_keys_are_grouped_by_hash(tables):
    names = ["market_name", "time_period", "condition", "upc"]
    folded = with_collation(tables["pricing_current"], "UTF8_LCASE_RTRIM", names)
    for df in (duplication.duplication_check(folded), duplication.duplicate_keys(folded)):
        plan = _plan(df)
        assert "HashAggregate" in plan
        assert "SortAggregate" not in plan


def test_pricing_pair_is_both_tables(spark, sf_dir, tmp_path):
    """One pass over the lines, with NULL and repeated keys and odd amounts among them."""
    for name in ("customer", "nation", "region", "orders", "part", "lineitem"):
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        if name == "lineitem":
            key = F.col("l_orderkey")
            odd = {
                "l_quantity": F.when(key % 9 == 0, -1.15).when(key % 7 > 0, F.col("l_quantity") + 0.37),
                "l_returnflag": F.when(key % 11 > 0, F.col("l_returnflag")),
            }
            df = df.withColumns(odd).union(df.filter("l_linenumber = 1"))
        if name == "part":
            df = df.union(df.filter("p_partkey % 5 = 0").withColumn("p_size", F.col("p_size") + 1))
        if name == "orders":
            dates = F.when(F.col("o_orderkey") % 13 > 0, F.col("o_orderdate"))
            df = df.withColumn("o_orderdate", dates)
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    with Workspace(spark, str(tmp_path)) as run:
        prior, current = fixtures.pricing_pair(spark, str(tmp_path), run)
        for pair, own in ((prior, fixtures.pricing_prior), (current, fixtures.pricing_current)):
            rows = own(spark, str(tmp_path))
            assert pair.schema == rows.schema and rows.count() > 100
            assert pair.exceptAll(rows).count() == rows.exceptAll(pair).count() == 0
            assert "lineitem" not in _plan(pair)


def test_suite_query_follows_its_tables(spark, sf_dir, tmp_path):
    """A report is of the tables as they are, not of an earlier run in the session."""
    import __spark_entry__ as entry

    for name in ("customer", "nation", "region", "orders", "part", "lineitem"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    query = entry.queries()["qc_suite_counts"]
    assert len(query(spark, str(tmp_path)).collect()) > 1
    few = spark.read.parquet(f"{sf_dir}/orders.parquet").filter("o_orderdate < '1997-01-01'")
    few.write.mode("overwrite").parquet(f"{tmp_path}/orders.parquet")
    report = query(spark, str(tmp_path))
    assert all(str(r[0]) < "1997" for r in report.select(report.columns[0]).collect())


def test_stored_items_are_counted_without_moving_them(spark, pricing, tmp_path):
    rows = [{"upc": str(i % 7) if i % 5 else None, "condition": "ab"[i % 2], "kvi_quad": "KVI" if i % 3 else None,
             "market_name": f"M{i % 4}"} for i in range(60)]
    df = pricing(*rows, {"upc": "1", "condition": None}, {"upc": None, "condition": "c"})
    with Workspace(spark, str(tmp_path)) as run:
        summary = suite.stored_summary(df, run, "current")
        found = back_data.period_condition_metrics(summary, "current")
        assert not re.search(r"hashpartitioning\([^)]*upc#", _plan(found))
        expected = back_data.period_condition_metrics(df, "current")
        assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))
