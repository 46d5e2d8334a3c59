"""Additive measures of a pricing table.

Nearly every report is a sum over classes of rows, or a count of distinct
items. ``measures`` turns rows into addable columns; ``slices`` adds them up
per period, condition, market and row class. Both have the same columns and
answer the same questions, so a report can read the rows directly or read a
stored ``Summary`` that is small enough to scan again and again.

Item counts stay apart. Counting distinct items next to the sums would make
Spark copy every row once per distinct column; a second, narrow scan moves
only the keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfaudit import schema as S
from shelfaudit.config import DEFAULT, QcConfig
from shelfaudit.functions.expr import PRINTS, index_terms, index_units, row_prints

DIMENSIONS = ["time_period", "condition", "market_name"]
CLASSES = ["is_kvi", "is_store", "is_sold"]
ADDITIVE = [
    "row_count", "upc_count", "units", "dollars", "market_units", "market_dollars",
    "index_whole", "index_rest", "index_units", *PRINTS,
]


@dataclass(frozen=True)
class Summary:
    """``measures``: dimensions, classes and additive columns.
    ``items``: time_period, condition, upc, is_kvi. ``distinct`` tells that it has one
    row per period, condition and item, so that reports need not move it to count."""

    measures: DataFrame
    items: DataFrame
    distinct: bool = False

    def item_count(self) -> Column:
        """The items of a group of one period and condition."""
        return F.count("upc") if self.distinct else F.count_distinct("upc")


def _is_kvi() -> Column:
    return F.col("kvi_quad") == S.KVI


def measures(
    pricing: DataFrame, config: QcConfig = DEFAULT, more: Sequence[Column | str] = ()
) -> DataFrame:
    """One output row per input row, with ``more`` columns passed on. A NULL class
    counts as "no"."""
    units, volume = F.col("units"), F.col("price_weighted_volume")
    whole, rest = index_terms(F.col("dollars"), volume, units, config.on_zero)
    prints = row_prints([F.col(n) for n in S.PRICING.fieldNames()])
    return pricing.select(
        *DIMENSIONS,
        _is_kvi().alias("is_kvi"),
        (F.col("outlier_flag") != S.OUTLIER).alias("is_store"),
        (
            (units > config.min_units) & (F.col("market_units") > config.min_market_units)
        ).alias("is_sold"),
        F.lit(1).cast("bigint").alias("row_count"),
        F.col("upc").isNotNull().cast("bigint").alias("upc_count"),
        "units",
        "dollars",
        "market_units",
        "market_dollars",
        whole.alias("index_whole"),
        rest.alias("index_rest"),
        index_units(volume, units, config.on_zero).alias("index_units"),
        *[c.alias(n) for n, c in prints.items()],
        *more,
    )


def slices(pricing: DataFrame, config: QcConfig = DEFAULT) -> DataFrame:
    """``measures`` added up; each map task emits one row per slice it met."""
    return totals(measures(pricing, config), DIMENSIONS + CLASSES)


def item_rows(pricing: DataFrame) -> DataFrame:
    return pricing.select("time_period", "condition", "upc", _is_kvi().alias("is_kvi"))


def items(pricing: DataFrame) -> DataFrame:
    """One row per period, condition and item."""
    return (
        item_rows(pricing)
        .groupBy("time_period", "condition", "upc")
        .agg(F.max("is_kvi").alias("is_kvi"))
    )


def summary_of(pricing: DataFrame | Summary, config: QcConfig = DEFAULT) -> Summary:
    """A stored summary as it is, or a table's rows in the shape of one."""
    if isinstance(pricing, Summary):
        return pricing
    return Summary(measures(pricing, config), item_rows(pricing))


def totals(rows: DataFrame, keys: list[str], columns: list[str] = ADDITIVE) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in columns])


def merge_groups(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Put two aggregates of one table, with one row per group each, side by side.

    Each column comes from one side only, so the greatest value is the value.
    Unlike a join this matches NULL keys, and costs one exchange.
    """
    both = left.unionByName(right, allowMissingColumns=True)
    columns = [c for c in both.columns if c not in keys]
    return both.groupBy(*keys).agg(*[F.max(c).alias(c) for c in columns])
