"""Column expressions shared by the checks. All are built-in functions.

Division by zero and unreadable dates end the query unless a lenient mode is
asked for. Both rely on ANSI mode, Spark's default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfaudit import schema as S

# Collations whose equality a function of plain text gives: (ignores case, trims).
FOLDS = {
    "UTF8_LCASE": (True, False),
    "UTF8_LCASE_RTRIM": (True, True),
    "UTF8_BINARY_RTRIM": (False, True),
}


def period_date(
    label: Column,
    side: str,
    formats: Sequence[str] = ("yyyy-MM-dd", "M/d/yyyy"),
    on_bad_date: str = "raise",
) -> Column:
    """Date held in the first (``"left"``) or last (``"right"``) ten characters."""
    ends = {"left": F.left, "right": F.right}
    if side not in ends:
        raise ValueError(f"side must be 'left' or 'right', not {side!r}")
    text = ends[side](label, F.lit(10))
    attempts = [F.try_to_date(text, fmt) for fmt in formats]
    if on_bad_date == "raise":
        attempts.append(text.cast("date"))
    return F.coalesce(*attempts)


def ratio(numerator: Column, denominator: Column, on_zero: str = "raise") -> Column:
    """Quotient as a double; ``on_zero="skip"`` makes it NULL over zero."""
    n, d = numerator.cast("double"), denominator.cast("double")
    return F.try_divide(n, d) if on_zero == "skip" else n / d


def pct_difference(
    new: Column, old: Column, on_zero: str = "raise", digits: int = 4
) -> Column:
    """Relative change, rounded half away from zero before any flag reads it."""
    return F.round(ratio(new - old, old, on_zero), digits)


def loss_flag(diff: Column, threshold: float, waived: bool = False) -> Column:
    """FAIL below the threshold; gains and unknown differences PASS."""
    return F.when(diff < threshold, S.WAIVED if waived else S.FAIL).otherwise(S.PASS)


def stability_flag(prior: Column, current: Column, diff: Column, tolerance: float) -> Column:
    """PASS if equal, INVESTIGATE if close, otherwise FAIL, also when unknown."""
    return (
        F.when(prior == current, S.PASS)
        .when(diff.between(-tolerance, tolerance), S.INVESTIGATE)
        .otherwise(S.FAIL)
    )


PRINTS = ["print_0", "print_1", "print_2", "print_3"]


def row_hash(columns: Sequence[Column], seed: int = 0) -> Column:
    """A 64-bit hash of a row. Which columns are NULL is hashed too, since the hash
    itself passes over them."""
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(F.lit(seed), nulls, *columns)


def row_prints(columns: Sequence[Column]) -> dict[str, Column]:
    """A 128-bit hash of a row as four numbers below 2**32, whose sums over rows are
    a fingerprint of the set of rows."""
    hashes = [row_hash(columns, seed) for seed in (0, 1)]
    halves = [half for h in hashes for half in (h.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h, 32))]
    return dict(zip(PRINTS, halves, strict=True))


def index_terms(
    dollars: Column, volume: Column, units: Column, on_zero: str = "raise"
) -> tuple[Column, Column]:
    """A row's share of the index numerator, its price ratio times its units, as
    the nearest whole number and the rest to 20 places.

    Decimals add up alike in any order. Sums of the whole numbers end the run
    beyond 38 digits.
    """
    term = 100 * ratio(dollars, volume, on_zero) * units.cast("double")
    whole = term.cast(S.INDEX_WHOLE)
    return whole, (term - whole.cast("double")).cast(S.INDEX_REST)


def index_sum(whole: Column, rest: Column) -> Column:
    """The numerator, from the sums of its two parts."""
    return whole.cast("double") + rest.cast("double")


def index_units(volume: Column, units: Column, on_zero: str = "raise") -> Column:
    """A row's share of the index denominator."""
    if on_zero == "skip":
        return F.when(volume.isNull() | (volume != 0), units)
    return units


def index_value(terms: Column, units: Column, on_zero: str = "raise") -> Column:
    """The index, from the sums of its terms and of its units."""
    return ratio(terms, units, on_zero)


def price_index(dollars: Column, volume: Column, units: Column, on_zero: str = "raise") -> Column:
    """Units-weighted mean of 100 x dollars / price-weighted volume."""
    whole, rest = index_terms(dollars, volume, units, on_zero)
    return index_value(
        index_sum(F.sum(whole), F.sum(rest)),
        F.sum(index_units(volume, units, on_zero)),
        on_zero,
    )


def folded(column: Column, kind: T.DataType) -> Column:
    """Text of the plain collation that is equal where ``column``, of type ``kind``, is.

    Spark groups plain text by hash, but sorts rows to group text of another
    collation. Types that need no folding, and collations of a language, come back as
    they are.
    """
    if getattr(kind, "collation", None) not in FOLDS:
        return column
    ignores_case, trims = FOLDS[kind.collation]
    text = F.collate(column, "UTF8_BINARY")
    if ignores_case:  # lower() writes a sigma at the end of a word differently
        text = F.translate(F.lower(text), "ς", "σ")
    return F.rtrim(text) if trims else text
