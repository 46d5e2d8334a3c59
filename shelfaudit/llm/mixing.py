"""Mixing sources to target weights, with DataFrame operations only.

Every document gets a hash-random key. Within its source the documents are put
in the order of that key, word counts are summed along it, and the mix takes
whole passes over the source and then documents up to the exact word where the
source's budget ends.

Defined results: null text has size 0 and nothing is taken of it; a null source
is a source of its own, the last; equal rows stay separate and are ordered by
key, id and size; an empty table gives an empty mix; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, documents, free_names, hash_key, n_words, running_total

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MAX_EPOCHS = 2
SEED = "mix"

SOURCE = ["_source", "_null"]


def targets(sizes: DataFrame, weights: Sequence[int], percent: int, epochs: int) -> DataFrame:
    """The target of each source, from one row (source key, source_size) each.

    In the order of limit over weight, a source is at its limit if its share of
    what those before it left is above the limit; the others share the rest by
    weight. This is where resharing the excess again and again ends.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy("_null", "_source")
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    limited = (
        sizes.withColumn("_n", (F.row_number().over(by_name) - 1) % len(weights))
        .withColumn("_w", F.element_at(cycle, (F.col("_n") + 1).cast("int")).cast("double"))
        .withColumn("_limit", F.col("source_size") * F.lit(float(epochs)))
        .withColumn("_budget", F.sum("source_size").over(everything) * F.lit(percent / 100))
    )
    up = Window.orderBy(F.col("_limit") / F.col("_w"), "_null", "_source")
    earlier = up.rowsBetween(Window.unboundedPreceding, -1)
    later = up.rowsBetween(0, Window.unboundedFollowing)
    left = limited.withColumn(
        "_left", F.col("_budget") - F.coalesce(F.sum("_limit").over(earlier), F.lit(0.0))
    ).withColumn("_weights", F.sum("_w").over(later))
    fits = F.col("_left") * F.col("_w") <= F.col("_limit") * F.col("_weights")
    first = F.min(F.when(fits, F.struct(F.col("_n_up"), "_left", "_weights"))).over(everything)
    return (
        left.withColumn("_n_up", F.row_number().over(up))
        .withColumn("_first", first)
        .select(
            *SOURCE,
            "source_size",
            F.when(F.col("_n_up") < F.col("_first._n_up"), F.col("_limit"))
            .otherwise(F.col("_w") * F.col("_first._left") / F.col("_first._weights"))
            .alias("target"),
        )
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    percent: int = SHARE_PERCENT,
    epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    row: str | None = None,
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every document, and its
    column `row`, which tells equal rows apart.

    `weights` go to the sources by name, repeating. The mix has `percent` of all
    words, but no source more than `epochs` times its size. `taken` counts the
    words that the mix takes from the document, repeats included.
    """
    own = [row] if row else []
    sized = cut(
        docs.select(
            *own,
            "doc_id",
            "source",
            F.coalesce("source", F.lit("")).alias("_source"),
            F.col("source").isNull().alias("_null"),
            n_words(F.col("text")).cast("long").alias("size"),
            hash_key(F.lit(seed), F.col("doc_id")).alias("_key"),
        )
    )
    per_source = sized.groupBy(*SOURCE).agg(F.sum("size").alias("source_size"))
    budgets = targets(per_source, weights, percent, epochs)
    ranked = running_total(
        sized, SOURCE, ["_key", "doc_id", "size", *own], F.col("size"), "_before"
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.floor("target") - whole * F.col("source_size") - F.col("_before")
    taken = whole * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    # One row per source: Spark broadcasts it if it is below the session's limit.
    return ranked.join(budgets, SOURCE).select(
        *own, "doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, with all their columns.

    A document that the mix takes a part of comes whole. Rows get numbers of their own
    and are stored with them, so that equal rows come as often as each is taken."""
    row, times, epoch = free_names(docs.columns, "_row", "_times", "_epoch")
    numbered = cut(docs.withColumn(row, F.monotonically_increasing_id()))
    whole = F.ceil(F.col("taken") / F.col("size")).cast("int")
    taken = mix_sources(numbered, row=row, **options).filter("taken > 0").select(row, whole.alias(times))
    return (
        numbered.join(taken, row)
        .withColumn(epoch, F.explode(F.sequence(F.lit(1), F.col(times))))
        .select(*docs.columns)
    )


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir)).drop("source")


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::DOUBLE AS s,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
           WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w
  FROM sized GROUP BY source),
left_over AS (
  SELECT *, sum(s) OVER () * 1.5::DOUBLE
            - coalesce(sum(2 * s) OVER (ORDER BY 2 * s / w, source NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
         sum(w) OVER (ORDER BY 2 * s / w, source NULLS LAST
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights,
         row_number() OVER (ORDER BY 2 * s / w, source NULLS LAST) AS n
  FROM sources),
first_free AS (
  SELECT n AS f, remaining AS r, weights AS ws FROM left_over
  WHERE remaining * w <= 2 * s * weights ORDER BY n LIMIT 1),
budgets AS (
  SELECT source, s, CASE WHEN n < f THEN 2 * s ELSE w * r / ws END AS target
  FROM left_over, first_free),
ranked AS (
  SELECT d.*, b.s, b.target,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, s::BIGINT AS source_size, target,
       (CASE WHEN s = 0 THEN 0 ELSE floor(target / s) * size + greatest(0, least(size,
          floor(target) - floor(target / s) * s - before)) END)::BIGINT AS taken
FROM ranked
"""
