"""Has any row of published history changed, even where all sums are equal?

Sums hide edits that offset each other, such as two items whose values were swapped.
A fingerprint does not: every row has a 128-bit hash of all its columns, and a group's
fingerprint is the sum of its rows' hashes, which is the same for any order of the rows
and counts repeated rows. Fingerprints are additive like the other measures, so stored
summaries hold them and coarser groups come from finer ones.

Where two versions of a group have different fingerprints, and only there, the rows are
read again to name the items that changed. Groups and items with NULL keys are compared
like others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfaudit import schema as S
from shelfaudit.config import DEFAULT, QcConfig
from shelfaudit.functions.expr import PRINTS, row_prints
from shelfaudit.operators.summary import DIMENSIONS, Summary, summary_of, totals

SUMS = ["units", "dollars", "market_units", "market_dollars"]
ITEM = [*DIMENSIONS, "upc"]


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b or not all(isinstance(t, T.DecimalType) for t in (a, b)):
        return a
    scale = max(a.scale, b.scale)
    whole = max(a.precision - a.scale, b.precision - b.scale)
    return T.DecimalType(min(38, whole + scale), scale)


def same_types(prior: DataFrame, current: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables with the pricing columns, their decimals at the scale of the finer
    one, so that equal numbers have equal hashes."""
    names = S.PRICING.fieldNames()
    types = {n: _wider(prior.schema[n].dataType, current.schema[n].dataType) for n in names}
    return tuple(df.select(*[F.col(n).cast(types[n]).alias(n) for n in names]) for df in (prior, current))


def _compared(prior: DataFrame, current: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Two additive tables side by side, with rows, status and whether sums are equal.

    One exchange in place of a join, so NULL keys meet too: the current side counts
    positive, the prior side negative, and what is left of a group is its change.
    """
    measured = ["row_count", *sums, *PRINTS]
    signed = [
        df.select(
            *keys,
            *[(F.col(c) * sign).alias(c) for c in measured],
            *[(F.col("row_count") * int(sign == own)).alias(f"{side}_rows") for side, own in SIDES.items()],
        )
        for df, sign in ((prior, -1), (current, 1))
    ]
    both = reduce(DataFrame.unionByName, signed)
    left = both.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in [*measured, *(f"{side}_rows" for side in SIDES)]]
    )
    same = reduce(lambda a, b: a & b, [F.col(c) == 0 for c in ["row_count", *PRINTS]])
    # A NULL measure is in the hash; a group without any value has no sum.
    equal = reduce(lambda a, b: a & b, [F.coalesce(F.col(c) == 0, F.lit(True)) for c in ["row_count", *sums]])
    status = (
        F.when(F.col("prior_rows") == 0, "new")
        .when(F.col("current_rows") == 0, "missing")
        .when(same, "same")
        .otherwise("changed")
    )
    return left.withColumns({"status": status, "sums_equal": equal})


SIDES = {"prior": -1, "current": 1}


def history_check(
    prior: DataFrame | Summary, current: DataFrame | Summary, config: QcConfig = DEFAULT
) -> DataFrame:
    """status of each period, condition and market: same, changed, missing from the
    current table or new in it. ``sums_equal`` tells what the sums of volumes alone
    would say, ``history_flag`` fails a group that is neither same nor new."""
    if isinstance(prior, DataFrame) and isinstance(current, DataFrame):
        prior, current = same_types(prior, current)
    columns = ["row_count", *SUMS, *PRINTS]
    sides = [totals(summary_of(p, config).measures, DIMENSIONS, columns) for p in (prior, current)]
    found = _compared(*sides, DIMENSIONS, SUMS)
    flag = F.when(F.col("status").isin("same", "new"), S.PASS).otherwise(S.FAIL)
    return found.select(
        *DIMENSIONS, "status", "sums_equal", flag.alias("history_flag"), "prior_rows", "current_rows"
    ).orderBy(*DIMENSIONS)


def _within(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of some groups, NULL keys included."""
    named = groups.select(*[F.col(k).alias(f"of_{k}") for k in DIMENSIONS])
    equal = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in DIMENSIONS]
    return rows.join(named, equal, "left_semi")


def changed_items(
    prior: DataFrame, current: DataFrame, checked: DataFrame | None = None
) -> DataFrame:
    """The items of groups that differ whose rows differ: status, rows and the change
    of each volume. ``checked`` is a ``history_check`` of the tables, such as a suite's.
    Only rows of groups that it calls changed are compared; groups that are wholly
    missing or new are named by it and not again item by item."""
    prior, current = same_types(prior, current)
    groups = (history_check(prior, current) if checked is None else checked).filter("status = 'changed'")
    sides = []
    for pricing in (prior, current):
        prints = row_prints([F.col(n) for n in S.PRICING.fieldNames()])
        rows = _within(pricing, groups).select(*ITEM, *SUMS, *[c.alias(n) for n, c in prints.items()])
        sides.append(totals(rows.withColumn("row_count", F.lit(1).cast("bigint")), ITEM, ["row_count", *SUMS, *PRINTS]))
    found = _compared(*sides, ITEM, SUMS).filter("status <> 'same'")
    changes = [F.col(c).cast("double").alias(f"{c}_diff") for c in SUMS]
    return found.select(*ITEM, "status", "prior_rows", "current_rows", *changes).orderBy(*ITEM)
