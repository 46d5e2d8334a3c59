from __future__ import annotations

import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfaudit.functions.expr import (
    index_value,
    loss_flag,
    pct_difference,
    period_date,
    price_index,
    stability_flag,
)


def _one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def _dec(x):
    return F.lit(x).cast("decimal(18,2)")


@pytest.mark.parametrize(
    "new, old, expected",
    [(90, 100, -0.1), (85, 100, -0.15), (103.004, 100, 0.03), (96.996, 100, -0.03)],
)
def test_difference_is_true_division_rounded_to_four(spark, new, old, expected):
    diff = pct_difference(F.lit(new), F.lit(old))
    assert _one(spark, diff) == expected


def test_difference_of_integers_does_not_truncate(spark):
    diff = pct_difference(F.lit(1).cast("bigint"), F.lit(3).cast("bigint"))
    assert _one(spark, diff) == -0.6667


def test_zero_base_ends_the_query(spark):
    with pytest.raises(PySparkException, match="DIVIDE_BY_ZERO"):
        _one(spark, pct_difference(_dec("5"), _dec("0")))
    assert _one(spark, pct_difference(_dec("5"), _dec("0"), "skip")) is None
    assert _one(spark, pct_difference(_dec("5"), _dec("4"), "skip")) == 0.25


@pytest.mark.parametrize(
    "diff, threshold, flag",
    [
        (-0.15, -0.15, "PASS"),
        (-0.1501, -0.15, "FAIL"),
        (-0.25, -0.25, "PASS"),
        (-0.2501, -0.25, "FAIL"),
        (9.0, -0.25, "PASS"),
        (None, -0.25, "PASS"),
    ],
)
def test_loss_flag(spark, diff, threshold, flag):
    assert _one(spark, loss_flag(F.lit(diff).cast("double"), threshold)) == flag


def test_waived_loss(spark):
    assert _one(spark, loss_flag(F.lit(-0.5), -0.15, waived=True)) == "WAIVED"
    assert _one(spark, loss_flag(F.lit(-0.1), -0.15, waived=True)) == "PASS"


@pytest.mark.parametrize(
    "prior, current, flag",
    [
        (100.0, 100.0, "PASS"),
        (100.0, 103.0, "INVESTIGATE"),
        (100.0, 97.0, "INVESTIGATE"),
        (100.0, 103.004, "INVESTIGATE"),
        (100.0, 103.01, "FAIL"),
        (100.0, 96.99, "FAIL"),
        (None, 100.0, "FAIL"),
        (100.0, None, "FAIL"),
        (None, None, "FAIL"),
    ],
)
def test_stability_flag(spark, prior, current, flag):
    p, c = F.lit(prior).cast("double"), F.lit(current).cast("double")
    assert _one(spark, stability_flag(p, c, pct_difference(c, p), 0.03)) == flag


@pytest.mark.parametrize(
    "label, side",
    [
        ("QTR 2020-04-25", "right"),
        ("12 WE 04/25/2020", "right"),
        ("2020-04-25 QTR", "left"),
        ("04/25/2020 12 WE", "left"),
    ],
)
def test_period_date_formats(spark, label, side):
    assert _one(spark, period_date(F.lit(label), side)) == datetime.date(2020, 4, 25)


def test_period_date_of_junk(spark):
    junk = F.lit("no date here")
    assert _one(spark, period_date(junk, "left", on_bad_date="null")) is None
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        _one(spark, period_date(junk, "left"))
    with pytest.raises(ValueError):
        period_date(junk, "middle")


def test_null_label_has_no_date(spark):
    assert _one(spark, period_date(F.lit(None).cast("string"), "left")) is None


def _index(spark, rows, on_zero="raise"):
    df = spark.createDataFrame(rows, "d string, p string, u string")
    d, p, u = (F.col(c).cast("decimal(18,2)") for c in "dpu")
    return df.agg(price_index(d, p, u, on_zero).alias("v")).first()["v"]


def test_price_index_weights_by_units(spark):
    # 100 x 10/20 weighs 3 units, 100 x 30/20 weighs 1: (50*3 + 150*1) / 4
    assert _index(spark, [("10", "20", "3"), ("30", "20", "1")]) == 75.0


def test_null_volume_counts_in_the_denominator_only(spark):
    assert _index(spark, [("10", "20", "3"), ("30", None, "1")]) == 37.5


def test_zero_volume(spark):
    rows = [("10", "20", "3"), ("30", "0", "1")]
    with pytest.raises(PySparkException, match="DIVIDE_BY_ZERO"):
        _index(spark, rows)
    # Skipping takes the row out of both sides, so the mean is not biased.
    assert _index(spark, rows, "skip") == 50.0
    assert _index(spark, rows + [("30", None, "1")], "skip") == 37.5
    assert _index(spark, [("30", "0", "1")], "skip") is None
    assert _index(spark, [("30", "5", "0")], "skip") is None


def test_price_index_of_huge_and_tiny_rows(spark):
    # 100 x 1 x 9e14 units in 1/1e8 parts is beyond a bigint
    assert _index(spark, [("7", "7", "900000000000000")]) == 100.0
    assert abs(_index(spark, [("1", "3", "0.01")]) - 100 / 3) < 1e-5


def test_index_sum_does_not_depend_on_row_order(spark):
    values = [(f"{i * 7 % 13 + 1}", f"{i * 5 % 11 + 3}", f"{i % 17 + 1}.{i % 9}") for i in range(400)]
    forward = spark.createDataFrame(values, "d string, p string, u string").coalesce(1)
    backward = spark.createDataFrame(values[::-1], "d string, p string, u string").repartition(7)
    d, p, u = (F.col(c).cast("decimal(18,2)") for c in "dpu")
    got = {df.agg(price_index(d, p, u).alias("v")).first()["v"] for df in (forward, backward)}
    assert len(got) == 1


def test_index_value_of_nothing_is_null(spark):
    none = F.lit(None).cast("decimal(28,0)")
    assert _one(spark, index_value(none, none)) is None


def test_price_index_of_fine_and_extreme_values(spark):
    assert _index(spark, [("1", "3", "0.01")]) == pytest.approx(100 / 3, rel=1e-12)
    schema = "d double, p double, u double"
    columns = [F.col(c) for c in "dpu"]

    def of(*row):
        return spark.createDataFrame([row], schema).agg(price_index(*columns).alias("v")).first().v

    assert of(1e-9, 1.0, 1.0) == pytest.approx(1e-7, rel=1e-12)
    assert of(1e17, 1.0, 1e17) == pytest.approx(1e19, rel=1e-12)
