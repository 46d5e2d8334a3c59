"""Has published history stayed the same?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfaudit.config import DEFAULT, QcConfig
from shelfaudit.functions.expr import index_sum, index_value, pct_difference, stability_flag
from shelfaudit.operators.comparison import (
    differences,
    key_status,
    pct_differences,
    side_by_side,
)
from shelfaudit.operators.summary import Summary, summary_of, totals

KEYS = ["time_period", "condition"]
MEASURES = [
    "item_count", "index", "focus_dollars", "focus_units", "rom_dollars", "rom_units", "markets",
]
# Measures in the order of the report's value columns.
VALUES = [
    "index", "item_count", "focus_dollars", "focus_units", "rom_dollars", "rom_units", "markets",
]


def period_condition_metrics(
    pricing: DataFrame | Summary, prefix: str, config: QcConfig = DEFAULT
) -> DataFrame:
    """Index, volumes, items and markets per period and condition, as doubles."""
    summary = summary_of(pricing, config)
    needed = [
        "units", "dollars", "market_units", "market_dollars", "index_whole", "index_rest", "index_units",
    ]
    by_market = totals(summary.measures, [*KEYS, "market_name"], needed)
    item_counts = summary.items.groupBy(*KEYS).agg(summary.item_count().alias("item_count"))
    # Every group has one row of items next to its rows of markets.
    groups = (
        by_market.unionByName(item_counts, allowMissingColumns=True)
        .groupBy(*KEYS)
        .agg(
            *[F.sum(c).alias(c) for c in [*needed, "item_count"]],
            F.count("market_name").alias("markets"),
        )
    )
    columns = {
        "index": index_value(
            index_sum(F.col("index_whole"), F.col("index_rest")), F.col("index_units"), config.on_zero
        ),
        "item_count": F.col("item_count"),
        "focus_dollars": F.col("dollars"),
        "focus_units": F.col("units"),
        "rom_dollars": F.col("market_dollars"),
        "rom_units": F.col("market_units"),
        "markets": F.col("markets"),
    }
    return groups.select(
        *KEYS, *[columns[n].cast("double").alias(f"{prefix}_{n}") for n in VALUES]
    )


def _sides(prior, current, config: QcConfig) -> tuple[DataFrame, DataFrame]:
    return (
        period_condition_metrics(prior, "prior", config),
        period_condition_metrics(current, "current", config),
    )


def _index4(side: str) -> Column:
    return F.round(F.col(f"{side}_index"), 4)


def _diffs(on_zero: str) -> dict[str, Column]:
    """The index is compared after rounding, everything else as it is."""
    return {
        **pct_differences(MEASURES, "prior", "current", on_zero),
        "index_pct_diff": pct_difference(_index4("current"), _index4("prior"), on_zero),
    }


def back_data_check(
    prior: DataFrame | Summary, current: DataFrame | Summary, config: QcConfig = DEFAULT
) -> DataFrame:
    def flag(name: str) -> Column:
        sides = [F.col(f"{s}_{name}") for s in ("prior", "current")]
        if name == "index":
            sides = [_index4("prior"), _index4("current")]
        return stability_flag(*sides, F.col(f"{name}_pct_diff"), config.stability_tolerance)

    return (
        side_by_side(*_sides(prior, current, config), KEYS)
        .withColumns(_diffs(config.on_zero))
        .withColumns({f"{n}_flag": flag(n) for n in MEASURES})
        .select(
            *KEYS,
            *[f"{n}_flag" for n in MEASURES],
            *[f"{n}_pct_diff" for n in MEASURES],
            *[f"prior_{n}" for n in VALUES],
            *[f"current_{n}" for n in VALUES],
        )
        .orderBy(*KEYS)
    )


def back_data_differences(
    prior: DataFrame | Summary, current: DataFrame | Summary, config: QcConfig = DEFAULT
) -> DataFrame:
    joined = side_by_side(*_sides(prior, current, config), KEYS)
    rounded = joined.withColumns({f"{s}_index": _index4(s) for s in ("prior", "current")})
    return differences(rounded, KEYS, MEASURES, "prior", "current", config.on_zero)


def back_data_missing_keys(
    prior: DataFrame | Summary, current: DataFrame | Summary
) -> DataFrame:
    """Periods and conditions of either table, which the inner join would hide."""
    sides = [summary_of(p).measures.select(*KEYS).distinct() for p in (prior, current)]
    return key_status(*sides, KEYS)
