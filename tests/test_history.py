"""Fingerprints of published history."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfaudit.functions.expr import PRINTS
from shelfaudit.operators import back_data, history
from shelfaudit.operators.summary import Summary, items, slices, summary_of, totals


def _statuses(df):
    return {(r.time_period, r.condition, r.market_name): r.status for r in df.collect()}


def test_swap_is_seen_where_sums_are_equal(pricing):
    rows = [{"upc": str(i), "units": str(i + 20), "dollars": str(7 * i + 1)} for i in range(6)]
    other = {"condition": "A"}
    prior = pricing(*rows, other)
    rows[1]["upc"], rows[4]["upc"] = "4", "1"
    current = pricing(*rows, other)
    flags = back_data.back_data_check(prior, current).first().asDict()
    assert {v for k, v in flags.items() if k.endswith("_flag")} == {"PASS"}
    found = {r.condition: r for r in history.history_check(prior, current).collect()}
    assert found["R"].status == "changed" and found["R"].sums_equal and found["R"].history_flag == "FAIL"
    assert found["A"].status == "same" and found["A"].history_flag == "PASS"
    changed = history.changed_items(prior, current).collect()
    assert [(r.upc, r.status, r.units_diff) for r in changed] == [("1", "changed", 3.0), ("4", "changed", -3.0)]


def test_order_of_rows_does_not_count_but_copies_do(pricing):
    rows = [{"upc": str(i)} for i in range(40)]
    prior, current = pricing(*rows), pricing(*reversed(rows)).repartition(7)
    assert set(_statuses(history.history_check(prior, current)).values()) == {"same"}
    # One row twice in place of two rows that are alike in all sums.
    twice = pricing(*rows[:-1], rows[0])
    check = history.history_check(prior, twice).first()
    assert check.status == "changed" and check.sums_equal
    assert [(r.upc, r.status) for r in history.changed_items(prior, twice).collect()] == [
        ("0", "changed"), ("39", "missing"),
    ]


def test_null_keys_and_values(pricing):
    rows = [{"market_name": None}, {"upc": None}, {"condition": None, "outlier_flag": None}, {"units": None}]
    prior = pricing(*rows)
    assert set(_statuses(history.history_check(prior, pricing(*rows))).values()) == {"same"}
    # A value that moves from one NULL column to another.
    a = pricing({"kvi_quad": "x", "outlier_flag": None, "market_name": None})
    b = pricing({"kvi_quad": None, "outlier_flag": "x", "market_name": None})
    assert _statuses(history.history_check(a, b)) == {("2020-01-01 QTR", "R", None): "changed"}
    assert history.changed_items(a, b).count() == 1


def test_missing_and_new_groups(pricing):
    prior = pricing({"market_name": "M"}, {"market_name": "Old"})
    current = pricing({"market_name": "M"}, {"market_name": "New"})
    found = {r.market_name: (r.status, r.history_flag) for r in history.history_check(prior, current).collect()}
    assert found == {"M": ("same", "PASS"), "Old": ("missing", "FAIL"), "New": ("new", "PASS")}
    assert history.changed_items(prior, current).count() == 0
    empty = prior.limit(0)
    assert history.history_check(empty, empty).collect() == []
    assert set(_statuses(history.history_check(empty, current)).values()) == {"new"}


def test_equal_numbers_of_other_scale_are_the_same(pricing):
    prior = pricing({"units": "1.5"}, {"upc": "2", "units": "7"})
    fine = prior.withColumn("units", F.col("units").cast("decimal(20,4)"))
    assert set(_statuses(history.history_check(prior, fine)).values()) == {"same"}
    finer = fine.withColumn("units", F.col("units") + F.lit("0.0001").cast("decimal(20,4)"))
    assert set(_statuses(history.history_check(prior, finer)).values()) == {"changed"}
    assert history.changed_items(prior, finer).count() == 2


def test_summaries_answer_alike_and_add_up(spark, sf_dir):
    from shelfaudit.sources import fixtures as X

    prior, current = X.pricing_prior(spark, sf_dir), X.pricing_current(spark, sf_dir)
    kept = [Summary(slices(p), items(p)) for p in (prior, current)]
    assert history.history_check(*kept).collect() == history.history_check(prior, current).collect()
    by_period = totals(kept[1].measures, ["time_period"], PRINTS)
    of_rows = totals(summary_of(current).measures, ["time_period"], PRINTS)
    assert sorted(by_period.collect()) == sorted(of_rows.collect())


def test_only_groups_that_differ_are_read_again(spark, sf_dir, tmp_path):
    """The rows that are hashed again come from a join with the groups that differ."""
    from shelfaudit.sources import fixtures as X

    prior, swapped = X.pricing_prior(spark, sf_dir), X.pricing_swapped(spark, sf_dir)
    prior.write.parquet(f"{tmp_path}/a")
    swapped.write.parquet(f"{tmp_path}/b")
    a, b = (spark.read.parquet(f"{tmp_path}/{x}") for x in "ab")
    checked = history.history_check(a, b)
    checked.write.parquet(f"{tmp_path}/checked")
    checked = spark.read.parquet(f"{tmp_path}/checked")
    plan = history.changed_items(a, b, checked)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LeftSemi") == 2 and "Python" not in plan
    found = history.changed_items(a, b, checked)
    assert {r.time_period[:4] for r in found.select("time_period").distinct().collect()} == {"1996"}
    assert found.count() > 0 and checked.filter("status = 'changed' AND NOT sums_equal").isEmpty()


@pytest.mark.parametrize("name", ["history_check_swapped", "history_changes_swapped"])
def test_planted_swaps_show(spark, sf_dir, name):
    import __spark_entry__ as entry

    found = entry.queries()[name](spark, sf_dir)
    assert found.filter("status = 'changed'").count() > 10
