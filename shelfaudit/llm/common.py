"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLANKS = " \t\n\x0b\x0c\r"
KEY_BITS = 60
ROW_BITS = 33  # of monotonically_increasing_id below the number of the partition


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def cut(df: DataFrame) -> DataFrame:
    """End the lineage of `df` in the folder of spark.checkpoint.dir, which all
    executors share. Without that setting a session of one machine gets a folder;
    on a cluster there is none that all could read."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint()


def settled(df: DataFrame) -> DataFrame:
    """`cut`, after which the shuffle files that `df` took are deleted. Spark otherwise
    keeps them until the driver happens to collect its garbage."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        # Spark reads the setting when it makes a DataFrame.
        return cut(df.select("*"))
    finally:
        if before is None:
            conf.unset(key)
        else:
            conf.set(key, before)


def free_names(taken: list[str], *names: str) -> list[str]:
    """`names`, with as many underscores behind each as make it differ from `taken`."""
    used = {t.lower() for t in taken}
    out = []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def n_words(text: Column) -> Column:
    """Runs of characters other than space and U+0009..U+000D; null has none."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(inner == "", 0).otherwise(F.size(F.split(inner, r"[\x20\x09-\x0D]+")))


def hash_key(*columns: Column) -> Column:
    """A uniform number below 2**60, the same in every run."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def _dealt(rows: DataFrame, sort: list[str]) -> DataFrame:
    """`rows` stored in the order of `sort`, with _at, a number that rises along it,
    and _part, the partition. Rows equal in `sort` are spread over partitions too."""
    salted = rows.withColumn("_salt", F.monotonically_increasing_id())
    dealt = salted.repartitionByRange(*sort, "_salt").sortWithinPartitions(*sort, "_salt")
    dealt = cut(dealt.drop("_salt").withColumn("_at", F.monotonically_increasing_id()))
    return dealt.withColumn("_part", F.shiftright("_at", ROW_BITS))


def running_total(
    df: DataFrame, by: list[str], order: list[str], weight: Column, out: str
) -> DataFrame:
    """Adds `out`: the sum of `weight` over the rows of the same `by` that come
    earlier in `order`; rows equal in `order` come in any order.

    The rows are range-sorted. Each range is summed by itself and offset by the
    ranges before it, so no task holds a whole group, be it rows of one key. `by`
    columns are not null.
    """
    dealt = _dealt(df.withColumn("_weight", weight), [*by, *order])
    parts = dealt.groupBy(*by, "_part").agg(F.sum("_weight").alias("_sum"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *by, "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset")
    )
    within = (
        Window.partitionBy(*by, "_part")
        .orderBy("_at")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.col("_offset") + F.coalesce(F.sum("_weight").over(within), F.lit(0))
    return (
        dealt.join(offsets, [*by, "_part"])
        .withColumn(out, before)
        .drop("_at", "_part", "_weight", "_offset")
    )


def with_ranks(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """`rows` with rank, their place from 0 within equal `by` (not null) by `order`,
    and size, how many they are there."""
    dealt = _dealt(rows, [*by, *order])
    runs = dealt.groupBy(*by, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy(*by)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")
    offsets = runs.select(
        *by, "_part", before.alias("_offset"), F.sum("_n").over(whole).alias("size")
    )
    return (
        dealt.join(offsets, [*by, "_part"])
        .withColumn("rank", F.col("_at") + F.col("_offset"))
        .drop("_at", "_part", "_offset")
    )
