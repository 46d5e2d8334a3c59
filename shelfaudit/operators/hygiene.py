"""Stray whitespace and control characters in a text column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfaudit.config import CHARACTERS, LINE_BREAKS


def holds(column: Column, code: int) -> Column:
    """Whether the text holds a character; a NULL text holds none.

    Searched byte for byte, since a collation that ignores trailing blanks
    would not see them.
    """
    text = F.collate(column, "UTF8_BINARY")
    return F.coalesce(F.contains(text, F.lit(chr(code))), F.lit(False))


def char_profile(
    df: DataFrame, column: str, characters: Mapping[str, int] = CHARACTERS
) -> DataFrame:
    """Distinct values of a column with a 1/0 flag per character."""
    values = df.select(column)
    flags = {n: F.when(holds(F.col(column), c), 1).otherwise(0) for n, c in characters.items()}
    collated = values.schema[0].dataType != T.StringType()
    if collated:
        # Values the collation holds equal may differ in their flags.
        return values.withColumns(flags).distinct()
    # The flags follow from the value, so only the value needs shuffling.
    return values.distinct().withColumns(flags)


def char_profile_summary(
    df: DataFrame, column: str, characters: Mapping[str, int] = CHARACTERS
) -> DataFrame:
    """Number of values holding each character: one scan, no value is shuffled."""
    counts = df.agg(
        *[F.count_if(holds(F.col(column), c)).alias(n) for n, c in characters.items()]
    )
    entries = [
        F.struct(
            F.lit(n).alias("character"), F.lit(c).alias("code"), F.col(n).alias("value_count")
        )
        for n, c in characters.items()
    ]
    return counts.select(F.inline(F.array(*entries)))


def stray_characters(
    df: DataFrame, column: str, characters: Mapping[str, int] = CHARACTERS
) -> str:
    """The profiled characters that occur, ready for ``strip_chars``.

    Collects one row per profiled character.
    """
    found = char_profile_summary(df, column, characters).filter("value_count > 0")
    return "".join(chr(r["code"]) for r in found.orderBy("code").collect())


def code_points(df: DataFrame, column: str) -> DataFrame:
    """Every character that the column holds: code, value_count (how many values hold
    it), is_control and is_space. No list of characters is needed.

    Each value gives its distinct characters, and each task adds them up before anything
    is shuffled, so a task sends one row for each character it met.
    """
    text = F.collate(F.col(column), "UTF8_BINARY")
    each = df.select(F.explode(F.array_distinct(F.split(text, ""))).alias("character"))
    counts = each.filter("character <> ''").groupBy("character").agg(F.count("*").alias("value_count"))
    return counts.select(
        F.ascii("character").alias("code"),
        "value_count",
        F.col("character").rlike(r"\p{Cc}").alias("is_control"),
        F.col("character").rlike(r"\p{Z}|[\x09-\x0D]").alias("is_space"),
    )


def control_characters(df: DataFrame, column: str, keep: str = "") -> str:
    """The control characters that the column holds, ready for ``strip_chars``, but for
    those in ``keep``. Collects one row for each of Unicode's 65 at most."""
    found = code_points(df, column).filter("is_control")
    return "".join(c for r in found.orderBy("code").collect() if (c := chr(r["code"])) not in keep)


def strip_chars(
    df: DataFrame, target: str, source: str | None = None, characters: str = LINE_BREAKS
) -> DataFrame:
    """Write ``source`` without the characters into ``target``, on every row.

    ``source`` defaults to ``target``; naming another column replaces the
    target's own text.
    """
    return df.withColumn(target, F.translate(F.col(source or target), characters, ""))
