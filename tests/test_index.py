from __future__ import annotations

import pytest
from pyspark.errors import PySparkException

from shelfaudit import schema as S
from shelfaudit.config import QcConfig
from shelfaudit.operators import index, trend
from shelfaudit.operators.summary import Summary, items, slices


def _by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_counts(pricing):
    df = pricing(
        {"upc": "1", "condition": "A"},
        {"upc": "1", "condition": "B", "market_name": "N"},
        {"upc": "2", "condition": None, "kvi_quad": "Other", "market_name": None},
        {"upc": None, "kvi_quad": "KVI"},
    )
    row = index.period_counts(df).first()
    assert (row.market_count, row.condition_count, row.row_count) == (2, 3, 4)
    assert (row.item_count, row.kvi_item_count) == (2, 1)
    assert row.dollars == 400


def test_item_that_is_kvi_in_one_row_only(pricing):
    df = pricing({"kvi_quad": "Other"}, {"kvi_quad": "KVI", "market_name": "N"}, {"kvi_quad": None})
    row = index.period_counts(df).first()
    assert (row.item_count, row.kvi_item_count) == (1, 1)


def test_kvi_count_is_null_without_kvi_rows_but_zero_without_codes(pricing):
    df = pricing(
        {"time_period": "2020-01-01 QTR", "kvi_quad": "Other"},
        {"time_period": "2020-04-01 QTR", "kvi_quad": "KVI", "upc": None},
        {"time_period": None, "kvi_quad": "KVI"},
    )
    got = {k[0]: r.kvi_item_count for k, r in _by(index.period_counts(df), "time_period").items()}
    assert got == {"2020-01-01 QTR": None, "2020-04-01 QTR": 0, None: None}


def test_unknown_outlier_flag_is_left_out(pricing):
    df = pricing({"outlier_flag": None}, {"outlier_flag": "Outlier"}, {"outlier_flag": "Normal"})
    assert index.store_index(df).first().dollars == 100
    assert index.period_counts(df).first().dollars == 300
    assert index.store_index(pricing({"outlier_flag": None})).count() == 0


def test_report_joins_indexes_and_counts(pricing):
    df = pricing(
        {"condition": "A", "kvi_quad": "KVI", "dollars": "10", "price_weighted_volume": "20"},
        {"condition": "A", "kvi_quad": "Other", "upc": "2"},
        {"condition": "B", "kvi_quad": "Other"},
        {"condition": "B", "kvi_quad": "KVI", "outlier_flag": "Outlier"},
        {"condition": "C", "outlier_flag": "Outlier"},
        {"condition": None},
        {"time_period": None, "condition": "A"},
    )
    rows = _by(index.index_report(df), "time_period", "condition")
    p = "2020-01-01 QTR"
    assert set(rows) == {(p, "A"), (p, "B"), (p, None), (None, "A")}
    assert rows[p, "A"].store_index == 125.0 and rows[p, "A"].kvi_index == 50.0
    assert rows[p, "A"].condition_count == 3.0 and rows[p, "A"].item_count == 2.0
    # no KVI row left once the outlier is gone
    assert rows[p, "B"].kvi_index is None and rows[p, "B"].kvi_dollars is None
    # NULL keys equal nothing in a join
    assert rows[p, None].store_index == 200.0 and rows[p, None].kvi_units is None
    assert rows[p, None].market_count == 1.0
    assert rows[None, "A"].market_count is None and rows[None, "A"].kvi_index is None


def test_report_has_the_declared_schema(pricing):
    got = index.index_report(pricing({})).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in S.QC_INDEX]


def test_zero_volume_of_an_outlier_does_not_matter_to_the_index(pricing):
    df = pricing({"price_weighted_volume": "0", "outlier_flag": "Outlier"}, {})
    assert index.store_index(df).first().store_index == 200.0
    with pytest.raises(PySparkException, match="DIVIDE_BY_ZERO"):
        index.store_index(pricing({"price_weighted_volume": "0"})).collect()


def test_skipping_zero_volumes(pricing):
    df = pricing({"price_weighted_volume": "0"}, {}, {"kvi_quad": "Other"})
    row = index.index_report(df, QcConfig(on_zero="skip")).first()
    assert (row.store_index, row.kvi_index) == (200.0, 200.0)
    assert (row.units, row.kvi_units) == (60.0, 40.0)


def test_stored_summary_gives_the_same_reports(spark, pricing):
    df = pricing(*[
        {
            "market_name": [None, "M", "N"][i % 3], "upc": [None, "1", "2", "3"][i % 4],
            "time_period": [None, "2020-01-01 QTR", "2020-04-01 QTR"][i // 3 % 3],
            "condition": ["A", "B", None][i // 2 % 3], "kvi_quad": ["KVI", "x", None][i % 3 - 1],
            "outlier_flag": ["Normal", "Outlier", None][i // 5 % 3],
            "units": f"{i % 7 + 1}.5", "dollars": f"{i}.25",
        }
        for i in range(80)
    ])
    summary = Summary(slices(df), items(df))
    for report in (index.period_counts, index.store_index, index.kvi_index, index.index_report):
        a = sorted(report(df).collect(), key=repr)
        b = sorted(report(summary).collect(), key=repr)
        assert a and a == b


# ----------------------------------------------------------------------- trend


def _report(spark, values, condition="A"):
    rows = [(f"20{10 + i}-01-01 Y", condition, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "time_period string, condition string, store_index double")


def test_trend_against_the_previous_five(spark):
    df = _report(spark, [100.0, 100.0, 100.0, 100.0, 100.0, 105.0, 120.0])
    rows = trend.trend_check(df, 0.05, ["store_index"]).orderBy("period_date").collect()
    assert [r.store_index_mean for r in rows] == [None] * 5 + [100.0, 101.0]
    assert [r.store_index_pct_diff for r in rows][5:] == [0.05, 0.1881]
    assert [r.store_index_flag for r in rows] == [None] * 5 + ["PASS", "FAIL"]
    assert [r.is_latest for r in rows] == [False] * 6 + [True]


def test_trend_is_per_condition_and_sorts_by_date(spark):
    # as text 12/31/2019 sorts after 01/31/2020
    rows = [("12/31/2019", "A", 10.0), ("01/31/2020", "A", 20.0), ("01/31/2020", "B", 7.0)]
    df = spark.createDataFrame(rows, "time_period string, condition string, store_index double")
    out = _by(trend.trend_check(df, 0.1, ["store_index"], periods=1), "time_period", "condition")
    assert out["01/31/2020", "A"].store_index_mean == 10.0
    assert out["01/31/2020", "A"].store_index_flag == "FAIL"
    assert out["01/31/2020", "B"].store_index_mean is None
    assert out["12/31/2019", "A"].is_latest is False


def test_trend_of_nothing_but_zeros(spark):
    rows = trend.trend_check(_report(spark, [0.0, 5.0]), 0.1, ["store_index"], 1).collect()
    assert [r.store_index_flag for r in rows] == [None, None]


def test_latest_is_that_of_the_report(spark):
    rows = [("2019-01-01", None, 1.0), ("2020-01-01", None, 1.0), ("2015-01-01", "B", 1.0)]
    rows += [("2020-01-01", "C", 1.0), ("01/01/2020", "C", 1.0)]
    df = spark.createDataFrame(rows, "time_period string, condition string, store_index double")
    out = trend.trend_check(df, 0.1, ["store_index"], 1).collect()
    latest = {(r.time_period, r.condition): (r.is_latest, r.condition_ended) for r in out}
    assert latest == {
        ("2019-01-01", None): (False, False),
        ("2020-01-01", None): (True, False),
        ("2015-01-01", "B"): (False, True),
        ("2020-01-01", "C"): (True, False),
        ("01/01/2020", "C"): (True, False),
    }
