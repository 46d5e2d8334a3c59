"""Distinct item counts that add up: items as bits of numbered words.

Items get numbers from 0 without gaps. In place of rows that name items, a summary holds
words of 64 items: which word, and one bit for each item that a slice has. Words are
combined by OR, so the items of several slices, files or runs are counted without going
back to the rows, and they sit in the same rows as the sums: volumes, counts of items
and counts of KVI items come from one scan.

The numbers are looked up by a broadcast of the dictionary as long as it has at most
``BROADCAST_ITEMS`` items. Beyond that rows have to be moved to their numbers, and most
words have a row or two: a second scan then moves the keys alone, and the sums, which
need no number, stand in rows without a word.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfaudit.config import DEFAULT, QcConfig
from shelfaudit.operators.summary import ADDITIVE, CLASSES, DIMENSIONS, Summary, measures, totals

WORD_BITS = 6
BROADCAST_ITEMS = 1_000_000
PARTS = 256  # tasks that hand out numbers


def item_numbers(items: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """upc, number of all distinct items; those of ``known`` (upc, number) keep theirs
    and the others follow. The same items get the same numbers in every run."""
    names = items.select("upc").filter("upc IS NOT NULL").distinct()
    first = 0
    if known is not None:
        names = names.join(known, "upc", "left_anti")
        first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
    part = F.pmod(F.xxhash64("upc"), F.lit(PARTS))
    dealt = names.withColumn("part", part)
    within = F.row_number().over(Window.partitionBy("part").orderBy("upc"))
    # One row for each part, PARTS at most.
    sizes = dealt.groupBy("part").agg(F.count("*").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    numbered = dealt.withColumn("within", within).join(F.broadcast(before), "part")
    new = numbered.select("upc", (F.col("before") + F.col("within") - 1 + first).alias("number"))
    return new if known is None else known.select("upc", "number").unionByName(new)


def bit_slices(
    pricing: DataFrame,
    numbers: DataFrame,
    n_items: int,
    config: QcConfig = DEFAULT,
    more: Sequence[str] = (),
) -> DataFrame:
    """``slices`` with the items of each slice: a row for each of its words; rows without
    an item have no word and no bits. ``numbers`` has ``n_items`` rows. ``more`` are
    columns of ``pricing`` to keep apart, such as its files. With more than
    ``BROADCAST_ITEMS`` items the sums of a slice are in its row without a word, and
    those of its words are NULL."""
    word = F.shiftright("number", WORD_BITS)
    bit = F.expr(f"shiftleft(1L, cast(number & {(1 << WORD_BITS) - 1} AS int))")
    keys = [*more, *DIMENSIONS, *CLASSES]
    if n_items > BROADCAST_ITEMS:
        named = measures(pricing, config, [*more, "upc"]).filter("upc IS NOT NULL")
        found = named.select(*keys, "upc").join(numbers, "upc")
        words = found.groupBy(*keys, word.alias("word")).agg(F.bit_or(bit).alias("bits"))
        none = {"word": F.lit(None).cast(words.schema["word"].dataType), "bits": F.lit(0).cast("long")}
        sums = totals(measures(pricing, config, more), keys).withColumns(none)
        columns = [*keys, "word", *ADDITIVE, "bits"]
        return sums.unionByName(words, allowMissingColumns=True).select(*columns)
    found = pricing.join(F.broadcast(numbers), "upc", "left")
    bits = F.coalesce(bit, F.lit(0).cast("long")).alias("bits")
    rows = measures(found, config, [*more, word.alias("word"), bits])
    return rows.groupBy(*keys, "word").agg(
        *[F.sum(c).alias(c) for c in ADDITIVE], F.bit_or("bits").alias("bits")
    )


def bit_summary(bits: DataFrame) -> Summary:
    """Bit slices in the shape of a summary, which all reports read. Its items are
    numbers: reports count them and do not name them."""

    def of(kind: Column) -> Column:
        return F.bit_or(F.when(kind, F.col("bits")))

    def has(name: str, place: Column) -> Column:
        one = F.call_function("shiftleft", F.lit(1).cast("long"), place)
        return F.col(name).bitwiseAND(one) != 0

    words = bits.groupBy("time_period", "condition", "word").agg(
        F.bit_or("bits").alias("bits"),
        of(F.col("is_kvi")).alias("kvi"),
        of(~F.col("is_kvi")).alias("other"),
        F.max("is_kvi").alias("any_kvi"),
    )
    places = F.filter(F.sequence(F.lit(0), F.lit((1 << WORD_BITS) - 1)), lambda i: has("bits", i))
    opened = words.withColumn("place", F.explode_outer(places))
    place = F.col("place")
    is_kvi = (
        F.when(place.isNull(), F.col("any_kvi"))
        .when(has("kvi", place), True)
        .when(has("other", place), False)
    )
    number = F.shiftleft("word", WORD_BITS) + place
    rows = opened.select("time_period", "condition", number.alias("upc"), is_kvi.alias("is_kvi"))
    return Summary(bits, rows, distinct=True)


def item_counts(bits: DataFrame, keys: list[str]) -> DataFrame:
    """item_count and kvi_item_count by any of the dimensions, from words alone."""
    kvi = F.bit_or(F.when(F.col("is_kvi"), F.col("bits")))
    words = bits.groupBy(*keys, "word").agg(F.bit_or("bits").alias("all"), kvi.alias("kvi"))
    return words.groupBy(*keys).agg(
        F.sum(F.bit_count("all")).cast("long").alias("item_count"),
        F.coalesce(F.sum(F.bit_count("kvi")), F.lit(0)).cast("long").alias("kvi_item_count"),
    )
