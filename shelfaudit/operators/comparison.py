"""What the coverage and back-data checks share: two aggregates side by side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfaudit.functions.expr import pct_difference


def side_by_side(
    old: DataFrame, new: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join two aggregates on plain equality. Neither side is hinted: their
    size depends on the data, so AQE picks the strategy from what it measures."""
    return old.join(new, list(keys), how)


def pct_differences(
    names: Sequence[str], old: str, new: str, on_zero: str
) -> dict[str, Column]:
    return {
        f"{n}_pct_diff": pct_difference(F.col(f"{new}_{n}"), F.col(f"{old}_{n}"), on_zero)
        for n in names
    }


def differences(
    joined: DataFrame,
    keys: Sequence[str],
    names: Sequence[str],
    old: str,
    new: str,
    on_zero: str,
) -> DataFrame:
    """Absolute and relative difference of each measure. ``null_diffs`` counts
    the relative ones that are unknown, which the flags cannot show."""
    relative = pct_differences(names, old, new, on_zero)
    absolute = {f"{n}_diff": F.col(f"{new}_{n}") - F.col(f"{old}_{n}") for n in names}
    unknown = reduce(lambda a, b: a + b, [F.col(n).isNull().cast("int") for n in relative])
    return (
        joined.withColumns({**absolute, **relative})
        .withColumn("null_diffs", unknown)
        .select(*keys, *absolute, *relative, "null_diffs")
    )


def key_status(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every key of either side: in ``both``, ``missing`` from new, or ``new``."""
    joined = side_by_side(
        old.select(*keys, F.lit(True).alias("in_old")),
        new.select(*keys, F.lit(True).alias("in_new")),
        keys,
        "full",
    )
    status = (
        F.when(F.col("in_new").isNull(), "missing")
        .when(F.col("in_old").isNull(), "new")
        .otherwise("both")
    )
    return joined.select(*keys, status.alias("key_status"))
