from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfaudit.config import QcConfig
from shelfaudit.functions.expr import folded
from shelfaudit.operators import back_data, coverage, duplication
from shelfaudit.sources.store import Workspace
from shelfaudit.sources.tables import with_collation


def _rows(df):
    return [r.asDict() for r in df.collect()]


# ------------------------------------------------------------------ duplicates


def test_null_in_a_key_is_a_value(pricing):
    df = pricing({"upc": None}, {"upc": None}, {"upc": "1"})
    row = duplication.duplication_check(df).first()
    assert (row.distinct_combinations, row.all_rows, row.duplication_flag) == (2, 3, "FAIL")
    assert [r.copies for r in duplication.duplicate_keys(df).collect()] == [2]


def test_no_rows_have_no_duplicates(pricing):
    row = duplication.duplication_check(pricing()).first()
    assert (row.distinct_combinations, row.all_rows, row.duplication_flag) == (0, 0, "PASS")


def test_keys_are_a_parameter(pricing):
    df = pricing({"condition": "A"}, {"condition": "B"})
    assert duplication.duplication_check(df).first().duplication_flag == "PASS"
    assert duplication.duplication_check(df, ["upc"]).first().duplication_flag == "FAIL"


def test_collation_decides_equality(pricing):
    df = pricing({"market_name": "Metro"}, {"market_name": "METRO  "})
    folded = with_collation(df, "UTF8_LCASE_RTRIM", ["market_name"])
    assert duplication.duplication_check(df).first().all_rows == 2
    assert duplication.duplication_check(df).first().distinct_combinations == 2
    assert duplication.duplication_check(folded).first().distinct_combinations == 1


SPELLINGS = ["Metro", "METRO  ", "metro", None, None, "Όλος", "ΌΛΟΣ", "other", " metro"]


def _spelled(pricing, collation):
    df = pricing(*[{"market_name": m} for m in SPELLINGS])
    return with_collation(df, collation, ["market_name"])


@pytest.mark.parametrize(
    ("collation", "found"),
    [
        ("UTF8_LCASE_RTRIM", {"METRO  ": 3, None: 2, "ΌΛΟΣ": 2}),
        ("UTF8_LCASE", {"Metro": 2, None: 2, "ΌΛΟΣ": 2}),
        ("UTF8_BINARY_RTRIM", {None: 2}),
        ("UNICODE_CI_RTRIM", {"METRO  ": 3, None: 2, "ΌΛΟΣ": 2}),
    ],
)
def test_repeated_collated_keys_keep_a_spelling(pricing, spark, collation, found):
    df = _spelled(pricing, collation)
    rows = duplication.duplicate_keys(df)
    assert rows.schema["market_name"].dataType == df.schema["market_name"].dataType
    assert {r.market_name: r.copies for r in rows.collect()} == found
    with Workspace(spark) as run:
        hashed = duplication.duplicate_keys_by_hash(df, run)
        assert {r.market_name: r.copies for r in hashed.collect()} == found
    row = duplication.duplication_check(df).first()
    assert row.distinct_combinations == len(SPELLINGS) - sum(n - 1 for n in found.values())
    assert row.distinct_combinations == df.select("market_name").distinct().count()


def test_folded_text_is_equal_where_the_collation_is(spark):
    """For every code point, alone and inside a word."""
    points = spark.range(1, 0x110000, 1, 8).filter("id NOT BETWEEN 55296 AND 57343")
    char = F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')")
    for text in (char, F.concat(F.lit("aσ"), char, F.lit("b "))):
        df = points.select(F.collate(text, "UTF8_LCASE_RTRIM").alias("t"))
        keys = df.withColumn("k", folded(F.col("t"), df.schema["t"].dataType))
        groups = keys.groupBy("t").agg(F.min("k").alias("low"), F.max("k").alias("high"))
        assert groups.filter("low <> high").isEmpty()
        assert groups.count() == keys.select("k").distinct().count()


# -------------------------------------------------------------------- coverage


def test_volume_filters_are_strict(raw, pricing):
    feed = raw({"units": "10"}, {"units": "10.01"}, {"comp_units": "0"}, {"units": None})
    assert [r.raw_item_count for r in coverage.raw_volume(feed).collect()] == [1]
    built = pricing({"units": "10"}, {"units": "10.01"}, {"market_units": "0"}, {"units": None})
    assert [r.template_item_count for r in coverage.template_volume(built).collect()] == [1.0]


def test_item_count_is_not_distinct_and_skips_null(raw, pricing):
    feed = raw({}, {}, {"upc": None})
    assert coverage.raw_volume(feed).first().raw_item_count == 2
    built = pricing({}, {}, {"upc": None})
    assert coverage.template_volume(built).first().template_item_count == 2.0


def test_two_labels_of_one_date(raw, pricing):
    feed = raw({"time_period": "QTR 2020-01-01"}, {"time_period": "Q1 01/01/2020"})
    built = pricing({})
    assert coverage.coverage_check(feed, built).count() == 2
    collapsed = QcConfig(collapse_labels=True)
    row = coverage.coverage_check(feed, built, collapsed).first()
    assert (row.raw_item_count, row.item_count_pct_diff) == (2, -0.5)


def test_coverage_flags_losses_only(raw, pricing):
    feed = raw({"units": "100", "dollars": "100", "comp_units": "100", "comp_dollars": "100"})
    built = pricing(
        {"units": "75", "dollars": "74.99", "market_units": "500", "market_dollars": "74"}
    )
    row = coverage.coverage_check(feed, built).first()
    assert row.client_units_flag == "PASS" and row.client_units_pct_diff == -0.25
    assert row.client_dollars_flag == "FAIL"
    assert row.rom_units_flag == "PASS" and row.rom_units_pct_diff == 4.0
    assert row.rom_dollars_flag == "FAIL"


def test_unknown_difference_passes_and_is_counted(raw, pricing):
    feed, built = raw({}), pricing({"dollars": None})
    assert coverage.coverage_check(feed, built).first().client_dollars_flag == "PASS"
    row = coverage.coverage_differences(feed, built).first()
    assert (row.null_diffs, row.client_dollars_diff) == (1, None)


def test_focus_markets_and_order(raw, pricing):
    rows = [
        {"market_name": m, "time_period": f"QTR 2020-0{q}-01"}
        for m in ("A", "B", "C")
        for q in (4, 1)
    ]
    feed = raw(*rows)
    built = pricing(*[{**r, "time_period": r["time_period"][4:] + " QTR"} for r in rows])
    out = coverage.coverage_check(feed, built, QcConfig(focus_markets=("A", "B"))).collect()
    assert [(str(r.period_date), r.market_name) for r in out] == [
        ("2020-01-01", "A"), ("2020-01-01", "B"), ("2020-04-01", "A"), ("2020-04-01", "B"),
    ]
    assert coverage.coverage_check(feed, built).count() == 6


def test_rom_difference_compares_rom_with_rom(raw, pricing):
    row = coverage.coverage_differences(
        raw({"dollars": "900", "comp_dollars": "30"}), pricing({"market_dollars": "20"})
    ).first()
    assert row.rom_dollars_diff == -10


def test_missing_and_new_keys(raw, pricing):
    feed = raw({"market_name": "A"}, {"market_name": "B"}, {"market_name": None})
    built = pricing({"market_name": "B"}, {"market_name": "C"}, {"market_name": None})
    assert [r.market_name for r in coverage.coverage_check(feed, built).collect()] == ["B"]
    status = [(r.market_name, r.key_status) for r in coverage.coverage_missing_keys(feed, built).collect()]
    # A NULL market equals nothing, so it is missing from both sides.
    assert sorted(status, key=repr) == sorted(
        [("A", "missing"), ("B", "both"), ("C", "new"), (None, "missing"), (None, "new")], key=repr
    )


def test_zero_base(raw, pricing):
    feed, built = raw({"comp_dollars": "0"}), pricing({})
    with pytest.raises(PySparkException, match="DIVIDE_BY_ZERO"):
        coverage.coverage_check(feed, built).collect()
    skip = QcConfig(on_zero="skip")
    assert coverage.coverage_check(feed, built, skip).first().rom_dollars_flag == "PASS"
    assert coverage.coverage_differences(feed, built, skip).first().null_diffs == 1
    prior = pricing({"dollars": "0"})
    assert back_data.back_data_check(prior, built, skip).first().focus_dollars_flag == "FAIL"


def test_markets_match_by_collation(raw, pricing):
    feed = raw({"market_name": "Metro"}, {"market_name": "METRO"}, {"market_name": "Rural"})
    built = pricing({"market_name": "metro "})
    config = QcConfig(focus_markets=("METRO",))
    assert coverage.coverage_check(feed, built, config).count() == 0
    folded = [with_collation(df, "UTF8_LCASE_RTRIM", ["market_name"]) for df in (feed, built)]
    row = coverage.coverage_check(*folded, config).first()
    assert (row.raw_item_count, row.template_item_count) == (2, 1.0)


def test_unreadable_label(raw, pricing):
    feed = raw({"time_period": "QTR to come!"}, {})
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        coverage.coverage_check(feed, pricing({})).collect()
    lenient = QcConfig(on_bad_date="null")
    assert coverage.coverage_check(feed, pricing({}), lenient).count() == 1
    assert _rows(coverage.unparsed_periods(feed, "right")) == [
        {"time_period": "QTR to come!", "row_count": 1}
    ]


def test_config_rejects_typos():
    for bad in (
        {"waive": frozenset({"items"})}, {"on_zero": "ignore"}, {"on_bad_date": "drop"},
        {"loss_thresholds": {"item_count": -0.1}},
    ):
        with pytest.raises(ValueError):
            QcConfig(**bad)


# ------------------------------------------------------------------- back data


def test_identical_tables_pass(pricing):
    df = pricing({"dollars": "0.10"}, {"upc": "2", "dollars": "0.20"}, {"upc": "3", "dollars": "0.30"})
    row = back_data.back_data_check(df, df.repartition(5)).first().asDict()
    assert {v for k, v in row.items() if k.endswith("_flag")} == {"PASS"}
    assert {v for k, v in row.items() if k.endswith("_pct_diff")} == {0.0}


def test_metrics(pricing):
    df = pricing(
        {"upc": "1", "units": "3", "dollars": "10", "price_weighted_volume": "20"},
        {"upc": "1", "units": "1", "dollars": "30", "price_weighted_volume": "20", "market_name": "N"},
        {"upc": None, "units": None, "dollars": "5", "market_name": None},
    )
    assert _rows(back_data.period_condition_metrics(df, "now")) == [{
        "time_period": "2020-01-01 QTR", "condition": "R", "now_index": 75.0,
        "now_item_count": 1.0, "now_focus_dollars": 45.0, "now_focus_units": 4.0,
        "now_rom_dollars": 90.0, "now_rom_units": 15.0, "now_markets": 2.0,
    }]


def test_null_groups_keep_their_items(pricing):
    df = pricing({"condition": None, "upc": "1"}, {"condition": None, "upc": "2"}, {})
    got = {r.condition: r.x_item_count for r in back_data.period_condition_metrics(df, "x").collect()}
    assert got == {None: 2.0, "R": 1.0}


def test_null_keys_never_match_across_tables(pricing):
    df = pricing({"condition": None}, {})
    assert [r.condition for r in back_data.back_data_check(df, df).collect()] == ["R"]


def test_back_data_thresholds(pricing):
    prior = pricing({"units": "100", "dollars": "100", "market_units": "100", "market_dollars": "100"})
    now = pricing({"units": "103", "dollars": "103.01", "market_units": "97", "market_dollars": "100"})
    row = back_data.back_data_check(prior, now).first()
    assert row.focus_units_flag == "INVESTIGATE"
    assert row.focus_dollars_flag == "FAIL"
    assert row.rom_units_flag == "INVESTIGATE"
    assert row.rom_dollars_flag == "PASS"


def test_index_is_compared_after_rounding(pricing):
    prior = pricing({"dollars": "1000000.00", "price_weighted_volume": "3000000.00"})
    now = pricing({"dollars": "1000000.00", "price_weighted_volume": "3000000.01"})
    row = back_data.back_data_check(prior, now).first()
    assert row.prior_index != row.current_index
    assert (row.index_flag, row.index_pct_diff) == ("PASS", 0.0)


def test_back_data_key_status(pricing):
    prior, now = pricing({"condition": "A"}, {}), pricing({"condition": "B"}, {})
    got = {(r.condition, r.key_status) for r in back_data.back_data_missing_keys(prior, now).collect()}
    assert got == {("A", "missing"), ("B", "new"), ("R", "both")}
    assert back_data.back_data_check(prior, now).count() == 1


def test_back_data_null_difference_fails(pricing):
    prior, now = pricing({"market_units": None}), pricing({})
    assert back_data.back_data_check(prior, now).first().rom_units_flag == "FAIL"
    assert back_data.back_data_differences(prior, now).first().null_diffs == 1


def test_row_order_changes_no_flag(spark, pricing):
    rows = [{"upc": str(i), "dollars": f"{i % 7}.{i % 10}{i % 3}", "units": f"{i % 5 + 1}.1"} for i in range(60)]
    df = pricing(*rows)
    a = back_data.back_data_check(df.orderBy("upc"), df.orderBy(F.desc("dollars")).repartition(6))
    assert {v for k, v in a.first().asDict().items() if k.endswith("_flag")} == {"PASS"}
