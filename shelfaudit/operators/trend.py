"""Is a period in line with the ones before it?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfaudit import schema as S
from shelfaudit.config import DEFAULT, QcConfig
from shelfaudit.functions.expr import pct_difference, period_date

KEYS = ["time_period", "condition"]


def _date(config: QcConfig) -> Column:
    return period_date(F.col("time_period"), "left", config.date_formats, config.on_bad_date)


def trend_check(
    index: DataFrame,
    tolerance: float,
    metrics: Sequence[str] = ("store_index", "dollars", "units"),
    periods: int = 5,
    config: QcConfig = DEFAULT,
) -> DataFrame:
    """Compare each period of an index report with the mean of the previous ones.

    No tolerance is implied by the data, so the caller names one. A flag is
    NULL while fewer than ``periods`` earlier values exist or the mean is 0.
    ``is_latest`` marks the newest period of the report, ``condition_ended`` a
    condition whose newest period is older. The windows run over a finished
    report, which has one row per period and condition.
    """
    order = Window.partitionBy("condition").orderBy("period_date", "time_period")
    before = order.rowsBetween(-periods, -1)
    out = index.select(*KEYS, *metrics).withColumn("period_date", _date(config))
    newest = F.max("period_date").over(Window.partitionBy())
    own = F.max("period_date").over(Window.partitionBy("condition"))
    out = out.withColumn("is_latest", F.coalesce(F.col("period_date") == newest, F.lit(False)))
    out = out.withColumn("condition_ended", F.coalesce(own < newest, F.lit(False)))
    columns = []
    for m in metrics:
        seen = F.count(m).over(before)
        mean = F.when(seen == periods, F.avg(m).over(before))
        diff = pct_difference(F.col(m), F.when(F.col(f"{m}_mean") != 0, F.col(f"{m}_mean")))
        off = F.abs(F.col(f"{m}_pct_diff")) > tolerance
        out = (
            out.withColumn(f"{m}_mean", mean)
            .withColumn(f"{m}_pct_diff", diff)
            .withColumn(f"{m}_flag", F.when(off, S.FAIL).when(~off, S.PASS))
        )
        columns += [m, f"{m}_mean", f"{m}_pct_diff", f"{m}_flag"]
    return out.select("period_date", *KEYS, "is_latest", "condition_ended", *columns)


def trend_step(
    state: DataFrame | None,
    report: DataFrame,
    tolerance: float,
    metrics: Sequence[str] = ("store_index", "dollars", "units"),
    periods: int = 5,
    config: QcConfig = DEFAULT,
) -> tuple[DataFrame, DataFrame]:
    """The trend of new periods from a kept state, and the state to keep next.

    ``state`` has the last rows of each condition, one more than ``periods``, so a run
    reads the index rows of its own periods and not those of all history. If the newest
    period comes again, it replaces the one in the state. Store the new state, for example by ``publish_files``, before the
    old one is dropped.
    """
    new = report.select(*KEYS, *metrics)
    rows = new
    named = new.select(*[F.col(k).alias(f"new_{k}") for k in KEYS])
    if state is not None:
        again = [F.col(k).eqNullSafe(F.col(f"new_{k}")) for k in KEYS]
        rows = state.select(*KEYS, *metrics).join(named, again, "left_anti").unionByName(new)
    found = trend_check(rows, tolerance, metrics, periods, config)
    own = [F.col(k).eqNullSafe(F.col(f"new_{k}")) for k in KEYS]
    newest = Window.partitionBy("condition").orderBy(
        F.desc_nulls_last("period_date"), F.desc_nulls_last("time_period")
    )
    kept = rows.withColumn("period_date", _date(config)).withColumn("age", F.row_number().over(newest))
    return found.join(named, own, "left_semi"), kept.filter(F.col("age") <= periods + 1).select(*KEYS, *metrics)
