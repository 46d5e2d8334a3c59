"""Random tables with NULLs against a plain-Python reading of each report."""

from __future__ import annotations

from collections import defaultdict
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfaudit import schema as S
from shelfaudit.operators import back_data, duplication, hygiene, index
from shelfaudit.operators.summary import Summary, items, slices

FEW = settings(
    max_examples=6, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True
)

_money = st.one_of(
    st.none(),
    st.decimals(min_value=1, max_value=10**6, places=2, allow_nan=False, allow_infinity=False),
)
_row = st.fixed_dictionaries({
    "market_name": st.sampled_from([None, "M", "N"]),
    "time_period": st.sampled_from([None, "2020-01-01 QTR", "2020-04-01 QTR"]),
    "upc": st.sampled_from([None, "1", "2", "3"]),
    "condition": st.sampled_from([None, "A", "B"]),
    "units": _money, "dollars": _money, "market_units": _money, "market_dollars": _money,
    "price_weighted_volume": _money,
    "kvi_quad": st.sampled_from([None, "KVI", "Other"]),
    "outlier_flag": st.sampled_from([None, "Normal", "Outlier"]),
})
_table = st.lists(_row, min_size=1, max_size=40)


def _frame(spark, rows):
    names = S.PRICING.fieldNames()
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], S.PRICING)


def _sum(values):
    known = [v for v in values if v is not None]
    return sum(known, Decimal(0)) if known else None


def _distinct(rows, name):
    return len({r[name] for r in rows} - {None})


def _index(rows):
    terms = [
        100 * r["dollars"] / r["price_weighted_volume"] * r["units"]
        for r in rows
        if None not in (r["dollars"], r["price_weighted_volume"], r["units"])
    ]
    units = _sum(r["units"] for r in rows)
    return float(sum(terms) / units) if terms and units is not None else None


def _groups(rows, *keys):
    out = defaultdict(list)
    for r in rows:
        out[tuple(r[k] for k in keys)].append(r)
    return out


def _close(a, b):
    if a is None or b is None:
        return a is b
    return abs(float(a) - float(b)) <= 1e-6 * max(1.0, abs(float(b)))


VOLUMES = ("dollars", "units", "market_dollars", "market_units")


@FEW
@given(rows=_table)
def test_index_report(spark, rows):
    df = _frame(spark, rows)
    periods = _groups(rows, "time_period")
    store = [r for r in rows if r["outlier_flag"] not in (None, "Outlier")]
    want = _groups(store, "time_period", "condition")
    for source in (df, Summary(slices(df), items(df))):
        got = {(r.time_period, r.condition): r for r in index.index_report(source).collect()}
        assert set(got) == set(want)
        for key, group in want.items():
            row = got[key].asDict()
            kvi = [r for r in group if r["kvi_quad"] == "KVI"] if None not in key else []
            assert _close(row["store_index"], _index(group))
            assert _close(row["kvi_index"], _index(kvi))
            for v in VOLUMES:
                assert _close(row[v], _sum(r[v] for r in group))
                assert _close(row[f"kvi_{v}"], _sum(r[v] for r in kvi))
            period = periods[key[:1]] if key[0] is not None else None
            counted = [row[c] for c in ("market_count", "condition_count", "item_count", "kvi_item_count")]
            if period is None:
                assert counted == [None] * 4
                continue
            period_kvi = [r for r in period if r["kvi_quad"] == "KVI"]
            assert counted == [
                _distinct(period, "market_name"), _distinct(period, "condition"),
                _distinct(period, "upc"), _distinct(period_kvi, "upc") if period_kvi else None,
            ]


@FEW
@given(rows=_table)
def test_period_condition_metrics(spark, rows):
    df = _frame(spark, rows)
    want = _groups(rows, "time_period", "condition")
    for source in (df, Summary(slices(df), items(df))):
        out = back_data.period_condition_metrics(source, "x").collect()
        assert len(out) == len(want)
        for row in out:
            group = want[row.time_period, row.condition]
            assert _close(row.x_index, _index(group))
            assert row.x_item_count == _distinct(group, "upc")
            assert row.x_markets == _distinct(group, "market_name")
            assert _close(row.x_focus_dollars, _sum(r["dollars"] for r in group))
            assert _close(row.x_rom_units, _sum(r["market_units"] for r in group))


@FEW
@given(rows=_table, extra=st.integers(0, 5))
def test_duplicates_add_rows_but_no_combinations(spark, rows, extra):
    before = duplication.duplication_check(_frame(spark, rows)).first()
    copied = [rows[i % len(rows)] for i in range(extra)]
    after = duplication.duplication_check(_frame(spark, rows + copied)).first()
    assert before.distinct_combinations == len(_groups(rows, *S.KEY))
    assert after.distinct_combinations == before.distinct_combinations
    assert after.all_rows == before.all_rows + extra


@FEW
@given(rows=_table)
def test_a_table_agrees_with_itself(spark, rows):
    whole = [
        {k: (Decimal(7) if v is None and k not in S.KEY + ["kvi_quad", "outlier_flag"] else v)
         for k, v in r.items()}
        for r in rows
    ]
    df = _frame(spark, whole)
    df = df.filter("upc is not null and market_name is not null")
    for row in back_data.back_data_check(df, df.repartition(3)).collect():
        flags = {v for k, v in row.asDict().items() if k.endswith("_flag")}
        assert flags == {"PASS"}


@FEW
@given(texts=st.lists(st.text(alphabet="ab \t\n\r\x0b\x08\x0cÿ", max_size=8), min_size=1, max_size=20))
def test_stripping_what_was_found_leaves_nothing(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "code string")
    found = hygiene.stray_characters(df, "code")
    clean = hygiene.strip_chars(df, "code", characters=found)
    assert sorted(r.code for r in clean.collect()) == sorted(
        "".join(c for c in t if c in "ab") for t in texts
    )
