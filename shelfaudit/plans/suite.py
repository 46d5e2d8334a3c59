"""The whole quality-control run."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from shelfaudit import schema as S
from shelfaudit.config import DEFAULT, QcConfig
from shelfaudit.operators.back_data import (
    back_data_check,
    back_data_differences,
    back_data_missing_keys,
)
from shelfaudit.operators.coverage import (
    coverage_check,
    coverage_differences,
    RawSummary,
    coverage_missing_keys,
    raw_slices,
    unparsed_periods,
)
from shelfaudit.operators.duplication import duplicate_keys, duplication_of
from shelfaudit.operators.history import history_check, same_types
from shelfaudit.operators.index import index_report, period_counts
from shelfaudit.operators.summary import Summary, items, slices
from shelfaudit.operators.trend import trend_check
from shelfaudit.sources.files import Pin, drop_all_but
from shelfaudit.sources.store import (
    Workspace,
    publish,
    publish_files,
    report_folder,
    shared_folder,
    snapshot,
)


def _together(spark: SparkSession, *jobs: Callable) -> list:
    """Run a few independent jobs at once, so that the last tasks of one do not
    leave the executors idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [job.result() for job in running]


def stored_summary(
    pricing: DataFrame, workspace: Workspace, name: str, config: QcConfig = DEFAULT
) -> Summary:
    """Summarise a table into the workspace, in two scans of it."""
    return Summary(
        *_together(
            pricing.sparkSession,
            lambda: workspace.write(slices(pricing, config), f"{name}_slices"),
            lambda: workspace.write(items(pricing), f"{name}_items"),
        ),
        distinct=True,
    )


def published_index(report: DataFrame, table: str | None, location: str) -> DataFrame:
    """Publish an index report under its titles, to a table or, without one, to a folder
    that points at its newest version, and return it in order."""
    shaped = S.titled(report, "index")
    if table is None:
        out = publish_files(shaped, location, shaped.schema)
    else:
        out = publish(shaped, table, location, shaped.schema)
    return out.orderBy("Time_Period", "Condition")


def run_qc_suite(
    raw: DataFrame,
    prior: DataFrame,
    template: DataFrame,
    index_table: str | None,
    config: QcConfig = DEFAULT,
    folder: str | None = None,
    freeze: bool | str = True,
    index_location: str | None = None,
    keep_reports: int | None = None,
) -> dict[str, DataFrame]:
    """Run every check on one version of each table and publish the index.

    The feed is read once, to add it up by market and label. The two pricing tables are
    read once to freeze them; of the frozen template the keys, slices and items are read,
    of the frozen prior table the slices and items; the reports then come from these
    summaries. ``freeze="pin"`` makes no copies: the tables are tables of files whose
    versions are pinned, and a file that changes before all is read ends the run with
    ``InputChanged`` and publishes nothing. ``freeze=False`` is for tables that cannot
    change during the run.

    Next to the checks come what their inner joins and flags hide: the status of
    every key, keys that occur twice, absolute and unknown differences, and
    labels without a readable date, and ``history``, which tells changes that sums hide.

    Reports are stored under ``folder``, the session's shared folder unless named,
    before the run's tables are dropped. The published index is kept in
    ``index_location``; unless named, below a ``folder`` that was, or else in the
    warehouse. Without an ``index_table`` it is published to that folder and no catalog
    is asked. ``keep_reports`` deletes the reports of all but so many runs.
    """
    spark = template.sparkSession
    if index_location is None:
        name = index_table or "qc_index"
        index_location = f"{folder}/{name}" if folder else report_folder(spark, name)
    folder = (folder or shared_folder(spark)).rstrip("/")
    reports = Workspace(spark, f"{folder}/reports")
    with Workspace(spark, folder) as run:
        published, pricing = same_types(prior, template)
        pins = [Pin(df) for df in (raw, prior, template)] if freeze == "pin" else []
        if freeze and not pins:
            pricing, published = _together(
                spark,
                lambda: snapshot(pricing, run, "template"),
                lambda: snapshot(published, run, "prior"),
            )
        feed, keys, current, before = _together(
            spark,
            lambda: RawSummary(run.write(raw_slices(raw, config), "raw_slices")),
            lambda: reports.write(duplicate_keys(pricing), "duplicate_keys"),
            lambda: stored_summary(pricing, run, "current", config),
            lambda: stored_summary(published, run, "prior_summary", config),
        )
        plans = {
            "duplication": duplication_of(keys, current.measures),
            "coverage": coverage_check(feed, current, config),
            "coverage_keys": coverage_missing_keys(feed, current, config),
            "coverage_differences": coverage_differences(feed, current, config),
            "back_data": back_data_check(before, current, config),
            "back_data_keys": back_data_missing_keys(before, current),
            "back_data_differences": back_data_differences(before, current, config),
            "history": history_check(before, current, config),
            "counts": period_counts(current, config),
            "unparsed_raw": unparsed_periods(feed, "right", config),
            "unparsed_template": unparsed_periods(current, "left", config),
        }
        stored = dict(
            zip(
                plans,
                _together(
                    spark, *[lambda n=n, p=p: reports.write(p, n) for n, p in plans.items()]
                ),
                strict=True,
            )
        )
        for pin in pins:
            pin.verify()
        counts = stored["counts"]
        report = index_report(current, config, counts)
        index = published_index(report, index_table, index_location)
        if config.trend_tolerance is not None:
            trend = trend_check(report, config.trend_tolerance, config=config)
            trend = reports.write(trend, "trend").orderBy("period_date", "condition")
    order = {
        "coverage": ["period_date", "market_name"],
        "coverage_keys": ["period_date", "market_name"],
        "coverage_differences": ["period_date", "market_name"],
        "back_data": ["time_period", "condition"],
        "back_data_keys": ["time_period", "condition"],
        "back_data_differences": ["time_period", "condition"],
        "counts": ["time_period"],
        "history": ["time_period", "condition", "market_name"],
    }
    if keep_reports is not None:
        own = reports.path.rsplit("/", 1)[1]
        drop_all_but(spark, f"{folder}/reports", "run-", keep_reports, [own])
    results = {n: df.orderBy(*order[n]) if n in order else df for n, df in stored.items()}
    results |= {"duplicate_keys": keys, "index": index}
    return results if config.trend_tolerance is None else {**results, "trend": trend}
