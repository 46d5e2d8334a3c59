"""Does the rebuilt table keep most of the raw volume?"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfaudit.config import DEFAULT, LOSS_THRESHOLDS, QcConfig
from shelfaudit.functions.expr import loss_flag, period_date
from shelfaudit.operators.comparison import (
    differences,
    key_status,
    pct_differences,
    side_by_side,
)
from shelfaudit.operators.summary import Summary, summary_of, totals

MEASURES = list(LOSS_THRESHOLDS)
KEYS = ["market_name", "period_date"]
RAW_VOLUMES = ["units", "comp_units", "dollars", "comp_dollars"]


def _focus(df: DataFrame, config: QcConfig) -> DataFrame:
    if config.focus_markets is None:
        return df
    return df.filter(F.col("market_name").isin(list(config.focus_markets)))


def _volume(rows: DataFrame, aggregates: dict, side: str, config: QcConfig) -> DataFrame:
    """Aggregate per market and period label, then read the label's date.

    Two labels of one date stay two rows unless ``collapse_labels`` is set.
    """

    def dated(df: DataFrame) -> DataFrame:
        date = period_date(F.col("time_period"), side, config.date_formats, config.on_bad_date)
        return df.withColumn("period_date", date)

    columns = [c.alias(name) for name, c in aggregates.items()]
    if config.collapse_labels:
        return dated(rows).groupBy(*KEYS).agg(*columns)
    grouped = rows.groupBy("market_name", "time_period").agg(*columns)
    return dated(grouped).select(*KEYS, *aggregates)


@dataclass(frozen=True)
class RawSummary:
    """``measures``: market_name, time_period, is_sold and additive columns."""

    measures: DataFrame


def raw_measures(raw: DataFrame, config: QcConfig = DEFAULT) -> DataFrame:
    """One output row per row of the feed, in columns that add up."""
    units, comp_units = F.col("units"), F.col("comp_units")
    return raw.select(
        "market_name",
        "time_period",
        ((units > config.min_units) & (comp_units > config.min_market_units)).alias("is_sold"),
        F.lit(1).cast("bigint").alias("row_count"),
        F.col("upc").isNotNull().cast("bigint").alias("upc_count"),
        *RAW_VOLUMES,
    )


def raw_slices(raw: DataFrame, config: QcConfig = DEFAULT) -> DataFrame:
    """The feed added up by market and label, in one scan: all that the reports need."""
    keys = ["market_name", "time_period", "is_sold"]
    return totals(raw_measures(raw, config), keys, ["row_count", "upc_count", *RAW_VOLUMES])


def raw_volume(raw: DataFrame | RawSummary, config: QcConfig = DEFAULT) -> DataFrame:
    rows = raw.measures if isinstance(raw, RawSummary) else raw_measures(raw, config)
    return _volume(
        rows.filter("is_sold"),
        {
            "raw_item_count": F.sum("upc_count"),
            "raw_client_units": F.sum("units"),
            "raw_rom_units": F.sum("comp_units"),
            "raw_client_dollars": F.sum("dollars"),
            "raw_rom_dollars": F.sum("comp_dollars"),
        },
        "right",
        config,
    )


def template_volume(template: DataFrame | Summary, config: QcConfig = DEFAULT) -> DataFrame:
    sold = summary_of(template, config).measures.filter("is_sold")
    return _volume(
        sold,
        {
            "template_item_count": F.sum("upc_count").cast("double"),
            "template_client_units": F.sum("units"),
            "template_rom_units": F.sum("market_units"),
            "template_client_dollars": F.sum("dollars"),
            "template_rom_dollars": F.sum("market_dollars"),
        },
        "left",
        config,
    )


def _sides(raw, template, config: QcConfig) -> tuple[DataFrame, DataFrame]:
    return (
        _focus(raw_volume(raw, config), config),
        _focus(template_volume(template, config), config),
    )


def coverage_check(
    raw: DataFrame | RawSummary, template: DataFrame | Summary, config: QcConfig = DEFAULT
) -> DataFrame:
    """Volume of both tables per market and date, with a flag per measure."""
    flags = {
        f"{n}_flag": loss_flag(
            F.col(f"{n}_pct_diff"), config.loss_thresholds[n], n in config.waive
        )
        for n in MEASURES
    }
    return (
        side_by_side(*_sides(raw, template, config), KEYS)
        .withColumns(pct_differences(MEASURES, "raw", "template", config.on_zero))
        .withColumns(flags)
        .select(
            *KEYS,
            *flags,
            *[f"raw_{n}" for n in MEASURES],
            *[f"template_{n}" for n in MEASURES],
            *[f"{n}_pct_diff" for n in MEASURES],
        )
        .orderBy("period_date", "market_name")
    )


def coverage_differences(
    raw: DataFrame | RawSummary, template: DataFrame | Summary, config: QcConfig = DEFAULT
) -> DataFrame:
    joined = side_by_side(*_sides(raw, template, config), KEYS)
    return differences(joined, KEYS, MEASURES, "raw", "template", config.on_zero)


def coverage_missing_keys(
    raw: DataFrame | RawSummary, template: DataFrame | Summary, config: QcConfig = DEFAULT
) -> DataFrame:
    """Market and date pairs of either table, which the inner join would hide."""
    return key_status(*[s.select(*KEYS).distinct() for s in _sides(raw, template, config)], KEYS)


def unparsed_periods(
    df: DataFrame | Summary | RawSummary, side: str, config: QcConfig = DEFAULT
) -> DataFrame:
    """Labels in which no date can be read, with their row count."""
    stored = isinstance(df, Summary | RawSummary)
    rows = F.sum("row_count") if stored else F.count("*")
    labels = df.measures if stored else df
    date = period_date(F.col("time_period"), side, config.date_formats, "null")
    return labels.groupBy("time_period").agg(rows.alias("row_count")).filter(date.isNull())
