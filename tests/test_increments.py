"""Kept summaries, pinned inputs, pointers, item bits, trend steps, hashed keys."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from shelfaudit import schema as S
from shelfaudit.config import QcConfig
from shelfaudit.operators import duplication, hygiene, item_bits
from shelfaudit.operators.back_data import period_condition_metrics
from shelfaudit.operators.index import index_report, period_counts
from shelfaudit.operators.summary import CLASSES, DIMENSIONS, Summary, items, slices, totals
from shelfaudit.operators.trend import trend_check, trend_step
from shelfaudit.plans import suite
from shelfaudit.plans.increments import SummaryStore
from shelfaudit.sources import fixtures as X
from shelfaudit.sources.files import InputChanged, Pin, point, pointed
from shelfaudit.sources.store import Workspace, publish_files, read_published


def _as_is(df):
    return df


def _reports(pricing):
    return [sorted(map(repr, r.collect())) for r in (index_report(pricing), period_counts(pricing))]


@pytest.fixture(scope="module")
def current(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("current"))
    X.pricing_current(spark, sf_dir).write.parquet(f"{path}/t")
    return spark.read.parquet(f"{path}/t")


# --------------------------------------------------------------- increments


def test_updates_read_changed_files_only(spark, current, tmp_path):
    table, folder = f"{tmp_path}/a table 100%", f"{tmp_path}/summary"
    old = F.col("time_period") < "2000"
    current.filter(old).repartition(3).write.parquet(f"{table}/old")
    store = SummaryStore(spark, folder)
    summary, read = store.update(table, _as_is)
    assert read == 3 and _reports(summary) == _reports(current.filter(old))

    current.filter(~old).repartition(2).write.parquet(f"{table}/new")
    read_tables = []

    def seen(df):
        read_tables.append(sorted(os.path.dirname(f) for f in df.inputFiles()))
        return df

    summary, read = store.update(table, seen)
    assert read == 2 and all(x.endswith("/new") for x in read_tables[-1])
    assert _reports(summary) == _reports(current)

    before = len(read_tables)
    summary, read = store.update(table, seen)
    assert read == 0 and len(read_tables) == before and _reports(summary) == _reports(current)

    # A file that is replaced, and files that are gone.
    changed = current.filter(~old).withColumn("units", F.col("units") + 1)
    changed.coalesce(1).write.mode("overwrite").parquet(f"{table}/new")
    summary, read = store.update(table, _as_is)
    assert read == 1 and _reports(summary) == _reports(current.filter(old).unionByName(changed))
    assert store.drop_unused() >= 1
    assert _reports(store.summary()) == _reports(spark.read.option("recursiveFileLookup", "true").parquet(table))


def test_other_choices_start_a_new_summary(spark, current, tmp_path):
    current.coalesce(1).write.parquet(f"{tmp_path}/t")
    SummaryStore(spark, f"{tmp_path}/s").update(f"{tmp_path}/t", _as_is)
    other = SummaryStore(spark, f"{tmp_path}/s", QcConfig(min_units=50))
    with pytest.raises(ValueError, match="no summary"):
        other.bits()
    assert other.update(f"{tmp_path}/t", _as_is)[1] == 1
    assert other.update(f"{tmp_path}/t", _as_is)[1] == 0


def test_an_update_that_dies_changes_nothing(spark, current, tmp_path):
    old = current.filter("time_period < '2000'")
    old.coalesce(1).write.parquet(f"{tmp_path}/t/a")
    store = SummaryStore(spark, f"{tmp_path}/s")
    store.update(f"{tmp_path}/t", _as_is)
    current.filter("time_period >= '2000'").coalesce(1).write.parquet(f"{tmp_path}/t/b")

    def broken(df):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        store.update(f"{tmp_path}/t", broken)
    assert _reports(store.summary()) == _reports(old)
    assert _reports(store.update(f"{tmp_path}/t", _as_is)[0]) == _reports(current)


# ---------------------------------------------------------------- item bits


def test_bits_count_as_rows_do(spark, pricing):
    rows = [{"upc": str(i % 150), "kvi_quad": "KVI" if i % 3 else "x", "market_name": f"M{i % 4}"} for i in range(400)]
    rows += [{"upc": None, "kvi_quad": "KVI"}, {"upc": None, "time_period": "2020-04-01 QTR"}]
    rows += [{"upc": "7", "time_period": None, "condition": None}]
    df = pricing(*rows)
    numbers = item_bits.item_numbers(df)
    found = sorted(r.number for r in numbers.collect())
    assert found == list(range(150))
    bits = item_bits.bit_slices(df, numbers, 150)
    assert _reports(item_bits.bit_summary(bits)) == _reports(df)
    counts = {r.condition: (r.item_count, r.kvi_item_count) for r in item_bits.item_counts(bits, ["condition"]).collect()}
    expected = df.groupBy("condition").agg(
        F.count_distinct("upc"), F.count_distinct(F.when(F.col("kvi_quad") == "KVI", F.col("upc")))
    )
    assert counts == {r[0]: (r[1], r[2]) for r in expected.collect()}


def test_many_items_are_numbered_without_moving_sums(spark, pricing, tmp_path, monkeypatch):
    rows = [
        {"upc": str(i % 150), "kvi_quad": {0: None, 1: "x"}.get(i % 3, "KVI"), "units": str(i % 30),
         "condition": {0: None, 1: "a"}.get(i % 4, "b"), "market_name": f"M{i % 5}"}
        for i in range(400)
    ]
    rows += [{"upc": None, "kvi_quad": "KVI"}, {"upc": None, "time_period": "2020-04-01 QTR"}]
    rows += [{"upc": "7", "time_period": None, "condition": None}] * 2
    config = QcConfig(on_zero="skip")
    pricing(*rows).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t").withColumn("_path", F.col("market_name"))
    numbers = item_bits.item_numbers(df)
    few = item_bits.bit_slices(df, numbers, 150, config, ("_path",))
    monkeypatch.setattr(item_bits, "BROADCAST_ITEMS", 149)
    many = item_bits.bit_slices(df, numbers, 150, config, ("_path",))
    assert many.schema.simpleString() == few.schema.simpleString()

    def found(bits):
        summary = item_bits.bit_summary(bits)
        sliced = totals(summary.measures, [*DIMENSIONS, *CLASSES, "_path"])
        metrics = period_condition_metrics(summary, "current", config)
        counts = item_bits.item_counts(bits, ["market_name", "is_sold"])
        frames = (sliced, metrics, counts, period_counts(summary, config), index_report(summary, config))
        return [sorted(map(repr, x.collect())) for x in frames]

    assert found(many) == found(few)
    of_rows = period_condition_metrics(df, "current", config)
    assert found(many)[1] == sorted(map(repr, of_rows.collect()))
    plan = many._jdf.queryExecution().executedPlan().toString()
    by_upc = re.findall(r"Exchange hashpartitioning\(upc#.*\n(.*\n.*)", plan)
    assert by_upc and not any("index_whole" in x or "dollars" in x for x in by_upc)
    # The join's sides are moved by item; what the sums are of is not.
    joined = plan[plan.index("Join") :]
    assert "print_0" not in joined and "index_whole" not in joined


def test_bits_take_one_scan_and_add_up(spark, current, tmp_path):
    numbers = item_bits.item_numbers(current)
    numbers.write.parquet(f"{tmp_path}/n")
    numbers = spark.read.parquet(f"{tmp_path}/n")
    n = numbers.count()
    plan = item_bits.bit_slices(current, numbers, n)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet .*?market_units", plan)) == 1 and "Broadcast" in plan
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    # Slices of two halves are the slices of the whole.
    half = [current.filter(F.crc32("upc") % 2 == i) for i in (0, 1)]
    parts = [item_bits.bit_slices(h, numbers, n) for h in half]
    both = item_bits.bit_summary(parts[0].unionByName(parts[1]))
    assert _reports(both) == _reports(current)


def test_numbers_are_kept(spark, pricing):
    known = item_bits.item_numbers(pricing({"upc": "b"}, {"upc": "a"}))
    more = item_bits.item_numbers(pricing({"upc": "c"}, {"upc": "a"}, {"upc": None}), known)
    found = {r.upc: r.number for r in more.collect()}
    assert {k: found[k] for k in "ab"} == {r.upc: r.number for r in known.collect()} and found["c"] == 2
    empty = item_bits.item_numbers(pricing({}).limit(0))
    assert empty.collect() == []


# ------------------------------------------------------------------- pinning


def test_pin_sees_replaced_and_deleted_files(spark, current, tmp_path):
    path = f"{tmp_path}/a b%20"
    current.repartition(2).write.parquet(path)
    df = spark.read.parquet(path)
    pin = Pin(df)
    pin.verify()
    name = next(f for f in sorted(os.listdir(path)) if f.startswith("part-"))
    current.limit(5).write.mode("append").parquet(path)
    pin.verify()  # files that were added are not part of the version
    os.utime(f"{path}/{name}", (1, 1))
    with pytest.raises(InputChanged, match="changed"):
        pin.verify()
    os.remove(f"{path}/{name}")
    with pytest.raises(InputChanged):
        pin.verify()
    with pytest.raises(ValueError, match="files"):
        Pin(spark.range(3))


def test_suite_with_pinned_tables(spark, sf_dir, current, tmp_path, monkeypatch):
    tables = {}
    for name in ("raw_pricing", "pricing_prior"):
        getattr(X, name)(spark, sf_dir).write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
    written = []
    write = Workspace.write

    def spy(self, df, name):
        written.append(name)
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans[name] = len(re.findall(r"FileScan parquet .*?raw_pricing", plan))
        return write(self, df, name)

    scans = {}
    monkeypatch.setattr(Workspace, "write", spy)
    args = tables["raw_pricing"], tables["pricing_prior"], current
    place = f"{tmp_path}/index"
    reports = suite.run_qc_suite(*args, None, freeze="pin", index_location=place, folder=str(tmp_path))
    assert not {"template", "prior", "raw"} & set(written)
    assert {n for n, x in scans.items() if x} == {"raw_slices"} and scans["raw_slices"] == 1
    count = reports["index"].count()
    assert count > 0
    # A file that changes while the suite runs ends it; what was published stays.
    found = suite.history_check

    def touch(*args):
        for f in os.listdir(f"{tmp_path}/pricing_prior"):
            if f.endswith(".parquet") and not f.startswith("."):
                os.utime(f"{tmp_path}/pricing_prior/{f}", (1, 1))
        return found(*args)

    monkeypatch.setattr(suite, "history_check", touch)
    with pytest.raises(InputChanged):
        suite.run_qc_suite(*args, None, freeze="pin", index_location=place, folder=str(tmp_path))
    assert reports["index"].count() == count and pointed(spark, place) is not None


# ------------------------------------------------------------------ pointers


def test_pointer_moves_forward(spark, tmp_path):
    folder = f"{tmp_path}/p"
    assert pointed(spark, folder) is None
    for i in range(5):
        point(spark, folder, f"Wert {i} é")
        assert pointed(spark, folder) == f"Wert {i} é"
    assert len([f for f in os.listdir(folder) if f.startswith("pointer-")]) == 2


def test_published_files_are_bounded(spark, pricing, tmp_path):
    location, schema = f"{tmp_path}/it's", pricing({}).schema
    with pytest.raises(ValueError, match="published"):
        read_published(spark, location, schema)
    for i in range(10):
        out = publish_files(pricing(*[{"upc": str(i)}] * (i + 1)), location, schema)
        assert out.count() == i + 1 and {r.upc for r in out.collect()} == {str(i)}
    left = os.listdir(location)
    assert len([f for f in left if f.startswith("version-")]) == 2
    # A publication that dies leaves the last one.
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        publish_files(pricing({}).withColumn("units", F.expr("1 / (units - units)")), location, schema)
    assert read_published(spark, location, schema).count() == 10


def test_reports_of_old_runs_go(spark, raw, pricing, tmp_path):
    for _ in range(4):
        suite.run_qc_suite(
            raw({}), pricing({}), pricing({}), None, folder=str(tmp_path), keep_reports=2
        )["counts"].collect()
    assert len([f for f in os.listdir(f"{tmp_path}/reports") if f.startswith("run-")]) == 2
    assert len([f for f in os.listdir(f"{tmp_path}/qc_index") if f.startswith("version-")]) <= 2


# --------------------------------------------------------------- trend steps


def test_steps_equal_the_window(spark):
    rows = [
        (f"20{y:02d}-01-01 QTR", c, float(100 + (y * 7 + i) % 5), float(y + 1), 10.0)
        for y in range(12) for i, c in enumerate(["A", "B", None]) if not (c == "B" and y > 8)
    ]
    report = spark.createDataFrame(rows, "time_period string, condition string, store_index double, dollars double, units double")
    whole = {(r.time_period, r.condition): r for r in trend_check(report, 0.05).collect()}
    state = None
    for y in range(12):
        new = report.filter(F.col("time_period").startswith(f"20{y:02d}"))
        found, state = trend_step(state, new, 0.05)
        state = spark.createDataFrame(state.collect(), report.schema)
        assert state.count() <= 18
        for r in found.collect():
            expected = whole[r.time_period, r.condition].asDict()
            got = r.asDict()
            for name in ("is_latest", "condition_ended"):  # of the newest period then
                expected.pop(name), got.pop(name)
            assert got == expected
    # The newest period once more replaces itself.
    again, state2 = trend_step(state, new, 0.05)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, found.collect()))
    assert sorted(map(repr, state2.collect())) == sorted(map(repr, state.collect()))


# --------------------------------------------------------------- hashed keys


def test_hashed_keys_equal_keys(spark, pricing, monkeypatch):
    rows = [{"upc": str(i)} for i in range(50)] + [{"upc": "3"}, {"upc": None}, {"upc": None}]
    rows += [{"market_name": None, "upc": "M"}, {"market_name": "M", "upc": None}]
    df = pricing(*rows)
    expected = sorted(map(repr, duplication.duplicate_keys(df).collect()))
    assert len(expected) == 2
    with Workspace(spark) as run:
        assert sorted(map(repr, duplication.duplicate_keys_by_hash(df, run).collect())) == expected
    # Every key has one of three hashes: keys that only share a hash are told apart.
    monkeypatch.setattr(duplication, "row_hash", lambda keys: F.coalesce(F.crc32(keys[2]) % 3, F.lit(0)))
    with Workspace(spark) as run:
        assert sorted(map(repr, duplication.duplicate_keys_by_hash(df, run).collect())) == expected


# --------------------------------------------------------------- characters


def test_code_points_find_what_no_list_names(spark):
    texts = ["a\x1bb​", "naïve \U0001f600", "\x07\x07", "", None, "tab\tand "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = {r.code: r for r in hygiene.code_points(df, "t").collect()}
    assert set(found) == {ord(c) for t in texts if t for c in t}
    assert found[0x1B].is_control and found[7].is_control and found[7].value_count == 1
    assert found[0xA0].is_space and not found[0xA0].is_control and found[9].is_space
    assert found[ord("a")].value_count == 3 and 0x1F600 in found
    strays = hygiene.control_characters(df, "t", keep="\t")
    assert strays == "\x07\x1b"
    clean = hygiene.strip_chars(df, "t", characters=strays)
    assert hygiene.control_characters(clean, "t") == "\t"
    plan = hygiene.code_points(df, "t")._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    assert all("HashAggregate" in lines[i + 1] for i, x in enumerate(lines) if "Exchange" in x)


# ------------------------------------------------------------- order of rows


def test_reports_come_in_order(spark, sf_dir):
    import __spark_entry__ as entry

    order = {
        "back_data_check": ["Time Period", "Condition"],
        "index_report": ["Time_Period", "Condition"],
        "qc_suite": ["Time_Period", "Condition"],
        "qc_suite_back_data": ["Time Period", "Condition"],
        "history_check": ["time_period", "condition", "market_name"],
    }
    for name, keys in order.items():
        rows = [tuple(r[k] for k in keys) for r in entry.queries()[name](spark, sf_dir).collect()]
        assert rows == sorted(rows) and len(rows) > 1, name
    cover = entry.queries()["coverage_check"](spark, sf_dir)
    titles = [S.TITLES["coverage"][k] for k in ("period_date", "market_name")]
    rows = [tuple(r[t] for t in titles) for r in cover.collect()]
    assert rows == sorted(rows) and len(rows) > 1


def test_summaries_still_agree(current):
    assert _reports(Summary(slices(current), items(current))) == _reports(current)
