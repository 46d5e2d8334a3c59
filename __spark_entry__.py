
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_queries  # noqa: E402
from shelfaudit import schema as S  # noqa: E402
from shelfaudit.config import CHARACTERS, NBSP_160, QcConfig  # noqa: E402
from shelfaudit.operators import (  # noqa: E402
    back_data,
    coverage,
    duplication,
    history,
    hygiene,
    index,
    item_bits,
    trend,
)
from shelfaudit.plans import suite  # noqa: E402
from shelfaudit.plans.increments import SummaryStore  # noqa: E402
from shelfaudit.sources import fixtures as X  # noqa: E402
from shelfaudit.sources.tables import pricing_table, read_table  # noqa: E402
from shelfaudit.sources.store import Workspace, publish, report_folder, snapshot  # noqa: E402

# The corpus operators and their pipeline may be absent.
try:
    import corpus_pipeline
    from shelfaudit.llm import queries as corpus
except ImportError:
    corpus = corpus_pipeline = None

FOCUS = QcConfig(focus_markets=tuple(X.FOCUS_MARKETS))
TREND_TOLERANCE = 0.05
TRENDING = replace(FOCUS, trend_tolerance=TREND_TOLERANCE)
LENIENT = QcConfig(on_zero="skip", on_bad_date="null", collapse_labels=True)
WAIVED = QcConfig(focus_markets=FOCUS.focus_markets, waive=frozenset({"item_count"}))
ALL_CHARACTERS = {**CHARACTERS, **NBSP_160}


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles; indexes, means and differences rounded to 4 places,
    beyond which the order of additions shows."""

    def column(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        if f.name.lower().endswith(("index", "_mean", "_diff")):
            c = F.round(c, 4)
        return c.alias(f.name)

    return df.select([column(f) for f in df.schema])


def _back_data_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = back_data.back_data_check(
        X.pricing_prior(spark, sf_dir), X.pricing_current(spark, sf_dir)
    )
    return S.titled(report, "back_data")


def _index_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = index.index_report(X.pricing_current(spark, sf_dir))
    return S.titled(report, "index").orderBy("Time_Period", "Condition")


def _published_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"qc_index_{uuid.uuid4().hex}"
    with Workspace(spark) as run:
        frozen = snapshot(X.pricing_current(spark, sf_dir), run)
        summary = suite.stored_summary(frozen, run, "current")
        report = index.index_report(summary)
        found = suite.published_index(report, table, f"{run.path}/published").checkpoint()
        spark.sql(f"DROP TABLE {table}")
    return found


def _published_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index report, published twice to a folder and read through its pointer."""
    with Workspace(spark) as run:
        location = f"{run.path}/published"
        prior, current = X.pricing_pair(spark, sf_dir, run)
        summary = suite.stored_summary(prior, run, "prior")
        suite.published_index(index.index_report(summary), None, location)
        summary = suite.stored_summary(current, run, "current")
        return suite.published_index(index.index_report(summary), None, location).checkpoint()


def _suite(spark: SparkSession, sf_dir: str, odd: bool) -> dict[str, DataFrame]:
    """The reports of a run of the suite. The odd run has duplicate keys and labels
    without a date. The pricing tables are made for this run alone and the feed is read
    once, so nothing is frozen."""
    with Workspace(spark) as run:
        prior, template = X.pricing_pair(spark, sf_dir, run)
        reports = suite.run_qc_suite(
            (X.raw_mixed if odd else X.raw_pricing)(spark, sf_dir),
            prior,
            X.odd(template) if odd else template,
            index_table=None,
            config=LENIENT if odd else TRENDING,
            freeze=False,
            index_location=report_folder(spark, f"qc_index_{'odd_' * odd}{os.path.basename(sf_dir)}"),
        )
    # Later runs replace the published index.
    return {**reports, "index": reports["index"].checkpoint()}


def _suite_report(name: str, title: str | None = None, odd: bool = False):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        report = _suite(spark, sf_dir, odd)[name]
        return S.titled(report, title) if title else report

    return query


def _of_bits(report, prepared=X.pricing_current):
    """A report that reads sums and distinct items from one table of bit slices. What is
    read again, the table and the numbers and slices made of it, is stored once."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        with Workspace(spark) as run:
            pricing = snapshot(prepared(spark, sf_dir), run)
            numbers = run.write(item_bits.item_numbers(pricing), "numbers")
            bits = run.write(item_bits.bit_slices(pricing, numbers, numbers.count()), "bits")
            return report(item_bits.bit_summary(bits)).checkpoint()

    return query


def _incremental_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index report of a table that grew, changed and shrank between three updates of
    the summary that is kept of it."""
    with Workspace(spark) as run:
        prior, current = X.pricing_pair(spark, sf_dir, run)
        table = f"{run.path}/table"
        store = SummaryStore(spark, f"{run.path}/summary")
        newest = F.col("time_period") >= "2000"
        current.filter(~newest).write.parquet(f"{table}/old")
        prior.filter(newest).write.parquet(f"{table}/new")
        store.update(table, shape=_as_is)
        current.filter(newest).write.mode("overwrite").parquet(f"{table}/new")
        store.update(table, shape=_as_is)
        summary, _ = store.update(table, shape=_as_is)
        return S.titled(index.index_report(summary), "index").checkpoint()


def _as_is(df: DataFrame) -> DataFrame:
    return df


def _hashed_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Workspace(spark) as run:
        dirty = X.pricing_dirty(spark, sf_dir)
        return duplication.duplicate_keys_by_hash(dirty, run).checkpoint()


def _stepped_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend of the periods from 2000 on, each year from the state that the years
    before it left."""
    report = index.index_report(X.pricing_current(spark, sf_dir)).checkpoint()
    year = F.left("time_period", F.lit(4))
    _, state = trend.trend_step(None, report.filter(year < "2000"), TREND_TOLERANCE)
    first, state = trend.trend_step(state, report.filter(year == "2000"), TREND_TOLERANCE)
    second, _ = trend.trend_step(state, report.filter(year > "2000"), TREND_TOLERANCE)
    return first.drop("is_latest", "condition_ended").unionByName(second.drop("is_latest", "condition_ended"))


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Workspace(spark) as run:
        return snapshot(X.pricing_current(spark, sf_dir), run).checkpoint()


def _load_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Back data of two catalog tables with a user's column names, in two databases,
    whose units have four decimals. One has its column names in capitals."""
    names = []
    with Workspace(spark) as run:
        made = X.pricing_pair(spark, sf_dir, run)
        for database, df in zip(("shelf_live", "shelf_work"), made, strict=True):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
            factor = F.lit("1.01").cast("decimal(3,2)")
            fine = df.withColumns({c: F.col(c) * factor for c in ("units", "market_units")})
            name = f"spark_catalog.{database}.pricing_{uuid.uuid4().hex}"
            # Names are found whatever the case of their letters.
            titles = {n: t.upper() if database == "shelf_work" else t for n, t in S.PRICING_SOURCE.items()}
            fine.withColumnsRenamed(titles).write.saveAsTable(name)
            names.append(name)
    tables = [pricing_table(read_table(spark, name)) for name in names]
    found = S.titled(back_data.back_data_check(*tables), "back_data").checkpoint()
    for name in names:
        spark.sql(f"DROP TABLE {name}")
    return found


def _trend_of_ended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend where one condition is unknown and one has ended."""
    ended = (F.col("condition") == "R") & (F.col("time_period") >= "1998")
    pricing = X.pricing_current(spark, sf_dir).filter(~ended)
    unknown = F.when(F.col("condition") != "A", F.col("condition"))
    report = index.index_report(pricing.withColumn("condition", unknown))
    return trend.trend_check(report, TREND_TOLERANCE)


def _strip_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite a column of a table: publish a new version of all its rows."""
    table = f"codes_{uuid.uuid4().hex}"
    with Workspace(spark) as run:
        location = f"{run.path}/codes"
        codes = X.codes(spark, sf_dir)
        before = publish(codes, table, location, codes.schema)
        after = hygiene.strip_chars(before, "original_upc", source="upc")
        found = publish(after, table, location, codes.schema).checkpoint()
        spark.sql(f"DROP TABLE {table}")
    return found


def _current(operator, *args, title: str | None = None):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = operator(X.pricing_current(spark, sf_dir), *args)
        return S.titled(df, title) if title else df

    return query


def _coverage(operator, config: QcConfig, title: str | None = None):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = operator(X.raw_pricing(spark, sf_dir), X.pricing_current(spark, sf_dir), config)
        return S.titled(df, title) if title else df

    return query


def _back(operator):
    return lambda spark, sf: operator(X.pricing_prior(spark, sf), X.pricing_current(spark, sf))


def _history_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables are read twice: to find the groups that differ, then their rows."""
    with Workspace(spark) as run:
        return history.changed_items(*X.pricing_pair(spark, sf_dir, run)).checkpoint()


def _codes(operator, *args, **kwargs):
    return lambda spark, sf: operator(X.codes(spark, sf), *args, **kwargs)


def entry(spark: SparkSession) -> DataFrame:
    """Has published history changed? On the smallest test data."""
    return _plain(_back_data_check(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    plans = {
        "duplication_check": _current(duplication.duplication_check, title="duplication"),
        "duplication_check_dirty": lambda spark, sf: S.titled(
            duplication.duplication_check(X.pricing_dirty(spark, sf)), "duplication"
        ),
        "duplicate_keys": lambda spark, sf: duplication.duplicate_keys(
            X.pricing_dirty(spark, sf)
        ),
        "duplicate_keys_by_hash": _hashed_duplicates,
        "raw_volume_mixed": lambda spark, sf: coverage.raw_volume(X.raw_mixed(spark, sf), LENIENT),
        "store_index_zero": lambda spark, sf: index.store_index(X.pricing_zero(spark, sf), LENIENT),
        "raw_volume": lambda spark, sf: coverage.raw_volume(X.raw_pricing(spark, sf)),
        "template_volume": _current(coverage.template_volume),
        "coverage_check": _coverage(coverage.coverage_check, FOCUS, "coverage"),
        "coverage_waived": _coverage(coverage.coverage_check, WAIVED, "coverage"),
        "coverage_differences": _coverage(coverage.coverage_differences, FOCUS),
        "coverage_missing_keys": _coverage(coverage.coverage_missing_keys, QcConfig()),
        # Raw labels end in their date, so none can be read at the front.
        "unparsed_periods": lambda spark, sf: coverage.unparsed_periods(
            X.raw_pricing(spark, sf), "left"
        ),
        "prior_metrics": lambda spark, sf: back_data.period_condition_metrics(
            X.pricing_prior(spark, sf), "prior"
        ),
        "current_metrics": _current(back_data.period_condition_metrics, "current"),
        "back_data_check": _back_data_check,
        "back_data_differences": _back(back_data.back_data_differences),
        "back_data_missing_keys": _back(back_data.back_data_missing_keys),
        "history_check": _back(history.history_check),
        "history_changes": _history_changes,
        "history_check_swapped": lambda spark, sf: history.history_check(
            X.pricing_prior(spark, sf), X.pricing_swapped(spark, sf)
        ),
        "history_changes_swapped": lambda spark, sf: history.changed_items(
            X.pricing_prior(spark, sf), X.pricing_swapped(spark, sf)
        ),
        "period_counts": _current(index.period_counts, title="counts"),
        "store_index": _current(index.store_index),
        "kvi_index": _current(index.kvi_index),
        "index_report": _index_report,
        "published_index": _published_index,
        "published_files": _published_files,
        "incremental_index": _incremental_index,
        "item_bits_counts": _of_bits(lambda s: S.titled(index.period_counts(s), "counts")),
        "item_bits_metrics": _of_bits(
            lambda s: back_data.period_condition_metrics(s, "prior"), X.pricing_prior
        ),
        "item_bits_kvi": _of_bits(
            lambda s: item_bits.item_counts(s.measures, ["time_period", "condition", "market_name"])
        ),
        "trend_steps": _stepped_trend,
        "qc_suite": _suite_report("index"),
        "qc_suite_history": _suite_report("history"),
        "qc_suite_trend": _suite_report("trend"),
        "qc_suite_back_data_differences": _suite_report("back_data_differences"),
        "qc_suite_duplicate_keys": _suite_report("duplicate_keys", odd=True),
        "qc_suite_unparsed_raw": _suite_report("unparsed_raw", odd=True),
        "qc_suite_unparsed_template": _suite_report("unparsed_template", odd=True),
        "qc_suite_duplication": _suite_report("duplication", "duplication"),
        "qc_suite_coverage": _suite_report("coverage", "coverage"),
        "qc_suite_coverage_keys": _suite_report("coverage_keys"),
        "qc_suite_coverage_differences": _suite_report("coverage_differences"),
        "qc_suite_back_data": _suite_report("back_data", "back_data"),
        "qc_suite_back_data_keys": _suite_report("back_data_keys"),
        "qc_suite_counts": _suite_report("counts", "counts"),
        "load_path_back_data": _load_path,
        "trend_check_ended": _trend_of_ended,
        "trend_check": lambda spark, sf: trend.trend_check(
            index.index_report(X.pricing_current(spark, sf)), TREND_TOLERANCE
        ),
        "snapshot": _snapshot,
        "char_profile": _codes(hygiene.char_profile, "original_upc"),
        "char_profile_nbsp": _codes(hygiene.char_profile, "upc", ALL_CHARACTERS),
        "char_profile_summary": _codes(hygiene.char_profile_summary, "upc", ALL_CHARACTERS),
        "char_profile_documents": lambda spark, sf: hygiene.char_profile_summary(
            spark.read.parquet(f"{sf}/documents.parquet"), "text", ALL_CHARACTERS
        ),
        "code_points": _codes(hygiene.code_points, "upc"),
        "code_points_documents": lambda spark, sf: hygiene.code_points(
            spark.read.parquet(f"{sf}/documents.parquet"), "text"
        ),
        "strip_controls": lambda spark, sf: hygiene.strip_chars(
            X.codes(spark, sf),
            "upc",
            characters=hygiene.control_characters(X.codes(spark, sf), "upc", keep="\t"),
        ),
        "strip_chars": lambda spark, sf: hygiene.strip_chars(
            X.codes(spark, sf),
            "upc",
            characters=hygiene.stray_characters(X.codes(spark, sf), "upc", ALL_CHARACTERS),
        ),
        "strip_chars_rewrite": _codes(hygiene.strip_chars, "original_upc", source="upc"),
        "strip_chars_in_place": _strip_in_place,
    }

    def plain(plan):
        return lambda spark, sf_dir: _plain(plan(spark, sf_dir))

    found = {name: plain(plan) for name, plan in plans.items()}
    if corpus:
        found |= corpus.queries() | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = oracle_queries.oracle_sql()
    if corpus:
        found |= corpus.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
