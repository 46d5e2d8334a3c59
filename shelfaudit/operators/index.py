"""Counts per period and price indexes per period and condition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfaudit import schema as S
from shelfaudit.config import DEFAULT, QcConfig
from shelfaudit.functions.expr import index_sum, index_value
from shelfaudit.operators.summary import (
    DIMENSIONS,
    Summary,
    merge_groups,
    summary_of,
    totals,
)

KEYS = ["time_period", "condition"]
VOLUMES = ["dollars", "units", "market_dollars", "market_units"]


def period_counts(pricing: DataFrame | Summary, config: QcConfig = DEFAULT) -> DataFrame:
    """Markets, conditions, rows, items and volumes per period, all rows.

    ``kvi_item_count`` is NULL, not 0, for a period without any KVI row.
    """
    summary = summary_of(pricing, config)
    # The first level leaves few rows, so the two distinct counts above it
    # cost nothing.
    by_market = totals(summary.measures, DIMENSIONS, ["row_count", *VOLUMES])
    sums = by_market.groupBy("time_period").agg(
        F.count_distinct("market_name").alias("market_count"),
        F.count_distinct("condition").alias("condition_count"),
        *[F.sum(c).alias(c) for c in ["row_count", *VOLUMES]],
    )
    item_counts = (
        summary.items.groupBy("time_period", "upc")
        .agg(F.max("is_kvi").alias("is_kvi"))
        .groupBy("time_period")
        .agg(
            F.count("upc").alias("item_count"),
            F.count(F.when(F.col("is_kvi"), F.col("upc"))).alias("kvi_items"),
            F.max("is_kvi").alias("has_kvi"),
        )
    )
    kvi = F.when(F.col("has_kvi") & F.col("time_period").isNotNull(), F.col("kvi_items"))
    return merge_groups(sums, item_counts, ["time_period"]).select(
        "time_period",
        "market_count",
        "condition_count",
        "row_count",
        "item_count",
        kvi.alias("kvi_item_count"),
        *VOLUMES,
    )


def _index(config: QcConfig, keep=lambda c: c) -> Column:
    names = ("index_whole", "index_rest", "index_units")
    whole, rest, units = (F.sum(keep(F.col(c))) for c in names)
    return index_value(index_sum(whole, rest), units, config.on_zero)


def _kvi_names() -> dict[str, str]:
    return {c: f"kvi_{c}" for c in VOLUMES}


def store_index(pricing: DataFrame | Summary, config: QcConfig = DEFAULT) -> DataFrame:
    """Index and volumes of the rows known not to be outliers."""
    rows = summary_of(pricing, config).measures.filter("is_store")
    return rows.groupBy(*KEYS).agg(
        _index(config).alias("store_index"), *[F.sum(c).alias(c) for c in VOLUMES]
    )


def kvi_index(pricing: DataFrame | Summary, config: QcConfig = DEFAULT) -> DataFrame:
    """The same for key-value items alone."""
    rows = summary_of(pricing, config).measures.filter("is_store and is_kvi")
    return rows.groupBy(*KEYS).agg(
        _index(config).alias("kvi_index"),
        *[F.sum(c).alias(name) for c, name in _kvi_names().items()],
    )


def index_report(
    pricing: DataFrame | Summary, config: QcConfig = DEFAULT, counts: DataFrame | None = None
) -> DataFrame:
    """Store index, KVI index and period counts in one row per period and condition.

    The counts cover all rows, the indexes only non-outliers. KVI and store
    sums come from one pass; a group with a NULL key gets no KVI values and a
    NULL period no counts, because such keys equal nothing in a join.
    """
    if counts is None:
        counts = period_counts(pricing, config)

    def kvi(col: Column) -> Column:
        return F.when(F.col("is_kvi"), col)

    has_key = F.col("time_period").isNotNull() & F.col("condition").isNotNull()
    rows = summary_of(pricing, config).measures.filter("is_store")
    both = rows.groupBy(*KEYS).agg(
        _index(config).alias("store_index"),
        *[F.sum(c).alias(c) for c in VOLUMES],
        _index(config, kvi).alias("kvi_index"),
        *[F.sum(kvi(F.col(c))).alias(name) for c, name in _kvi_names().items()],
    )
    masked = both.withColumns(
        {n: F.when(has_key, F.col(n)) for n in ["kvi_index", *_kvi_names().values()]}
    )
    counts = counts.select(
        "time_period", "market_count", "condition_count", "item_count", "kvi_item_count"
    )
    return masked.join(counts, "time_period", "left").select(
        [F.col(f.name).cast(f.dataType) for f in S.QC_INDEX]
    )
