from __future__ import annotations

import pytest

from shelfaudit.config import CHARACTERS, NBSP_160
from shelfaudit.operators import hygiene
from shelfaudit.sources.tables import with_collation

ALL = {**CHARACTERS, **NBSP_160}


def _frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "code string")


@pytest.mark.parametrize("name", list(ALL))
def test_each_character_sets_its_flag_alone(spark, name):
    df = _frame(spark, f"12{chr(ALL[name])}34")
    row = hygiene.char_profile(df, "code", ALL).first().asDict()
    assert {n for n in ALL if row[n] == 1} == {name}


def test_profile_is_distinct_and_null_has_no_flags(spark):
    df = _frame(spark, "a b", "a b", None, None, "ab")
    rows = {r.code: r for r in hygiene.char_profile(df, "code").collect()}
    assert len(rows) == 3 and hygiene.char_profile(df, "code").count() == 3
    assert rows["a b"].space == 1 and rows["ab"].space == 0 and rows[None].space == 0


def test_trailing_blank_under_a_collation(spark):
    df = with_collation(_frame(spark, "a", "a ", "A"), "UTF8_LCASE_RTRIM", ["code"])
    # equal values, different flags: both kinds stay
    assert sorted(r.space for r in hygiene.char_profile(df, "code").collect()) == [0, 1]


def test_summary_counts_values(spark):
    df = _frame(spark, "a b", "a b", "c\td", None)
    got = {r.character: r.value_count for r in hygiene.char_profile_summary(df, "code", ALL).collect()}
    assert got == {**dict.fromkeys(ALL, 0), "space": 2, "horizontal_tab": 1}
    assert hygiene.char_profile_summary(_frame(spark), "code").count() == len(CHARACTERS)


def test_strip_defaults_to_line_breaks(spark):
    df = _frame(spark, "1\r\n2 3", "\n", None)
    assert [r.code for r in hygiene.strip_chars(df, "code").collect()] == ["12 3", "", None]


def test_strip_into_another_column_replaces_it(spark):
    df = spark.createDataFrame([("old", "1\n2"), ("kept?", None)], "target string, source string")
    out = hygiene.strip_chars(df, "target", "source").collect()
    assert [(r.target, r.source) for r in out] == [("12", "1\n2"), (None, None)]


def test_profile_feeds_strip(spark):
    text = "x" + "".join(chr(c) for c in ALL.values()) + "y"
    df = _frame(spark, text, "plain")
    found = hygiene.stray_characters(df, "code", ALL)
    assert set(found) == {chr(c) for c in ALL.values()}
    clean = hygiene.strip_chars(df, "code", characters=found)
    assert sorted(r.code for r in clean.collect()) == ["plain", "xy"]
    assert hygiene.stray_characters(clean, "code", ALL) == ""
    assert hygiene.strip_chars(clean, "code", characters=found).collect() == clean.collect()


def test_long_texts_are_read_to_the_end(spark):
    df = _frame(spark, "x" * 200_000 + "\t")
    assert hygiene.stray_characters(df, "code") == "\t"
