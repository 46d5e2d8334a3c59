"""Are the key columns unique?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfaudit import schema as S
from shelfaudit.functions.expr import FOLDS, folded, row_hash
from shelfaudit.sources.store import Workspace

PLAIN = "UTF8_BINARY"


def _copies(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    # Grouping keeps keys holding NULL, as DISTINCT does and count(DISTINCT a, b)
    # does not.
    equal = [folded(F.col(k), df.schema[k].dataType).alias(k) for k in keys]
    return df.groupBy(*equal).agg(F.count("*").alias("copies"))


def _collated(df: DataFrame, keys: Sequence[str]) -> dict[str, str]:
    """The collations of the keys that compare otherwise than byte for byte."""
    found = {k: getattr(df.schema[k].dataType, "collation", PLAIN) for k in keys}
    return {k: c for k, c in found.items() if c != PLAIN}


def _labelled_copies(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The repeated keys of collated columns, each as one of its rows spells it.

    Spellings are counted first, then those that fold to one key are added up; of the
    spellings of a repeated key the first in byte order is its label.
    """
    collations = _collated(df, keys)
    spelled = (
        df.withColumns({k: F.collate(F.col(k), PLAIN) for k in collations})
        .groupBy(*keys)
        .agg(F.count("*").alias("rows"))
    )
    as_given = {k: F.collate(F.col(k), c) for k, c in collations.items()}
    equal = [f"equal_{i}" for i in range(len(keys))]
    spelled = spelled.withColumns(
        {
            e: folded(as_given.get(k, F.col(k)), df.schema[k].dataType)
            for e, k in zip(equal, keys, strict=True)
        }
    )
    repeated = (
        spelled.groupBy(*equal)
        .agg(F.sum("rows").alias("copies"))
        .filter("copies > 1")
        .toDF(*[f"repeated_{e}" for e in equal], "copies")
    )
    same = [F.col(e).eqNullSafe(F.col(f"repeated_{e}")) for e in equal]
    place = F.row_number().over(Window.partitionBy(*equal).orderBy(*keys))
    first = spelled.join(repeated, same).withColumn("place", place).filter("place = 1")
    return first.withColumns(as_given).select(*keys, "copies")


def duplication_check(df: DataFrame, keys: Sequence[str] = tuple(S.KEY)) -> DataFrame:
    """Distinct key combinations against all rows, from one shuffle."""
    counts = _copies(df, keys).agg(
        F.count("*").alias("distinct_combinations"),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("all_rows"),
    )
    return _flagged(counts)


def duplication_of(duplicates: DataFrame, rows: DataFrame) -> DataFrame:
    """The same report from a table's ``duplicate_keys`` and its row counts
    (``row_count``, to be added up), without another pass over its keys."""
    extra = duplicates.select((F.col("copies") - 1).alias("extra"), F.lit(0).alias("rows"))
    both = extra.union(rows.select(F.lit(0), "row_count")).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("all_rows"),
        F.coalesce(F.sum("extra"), F.lit(0)).alias("extra"),
    )
    distinct = (F.col("all_rows") - F.col("extra")).alias("distinct_combinations")
    return _flagged(both.select(distinct, "all_rows"))


def _flagged(counts: DataFrame) -> DataFrame:
    same = F.col("distinct_combinations") == F.col("all_rows")
    return counts.withColumn("duplication_flag", F.when(same, S.PASS).otherwise(S.FAIL))


def duplicate_keys(df: DataFrame, keys: Sequence[str] = tuple(S.KEY)) -> DataFrame:
    """The key combinations that occur more than once, with their count."""
    if _collated(df, keys):
        return _labelled_copies(df, keys)
    return _copies(df, keys).filter(F.col("copies") > 1)


def duplicate_keys_by_hash(
    df: DataFrame, workspace: Workspace, keys: Sequence[str] = tuple(S.KEY)
) -> DataFrame:
    """The same as ``duplicate_keys``, for long keys that are nearly all unique.

    First 64-bit hashes of the keys are counted, so eight bytes of a key are shuffled
    and not its text. Then the keys themselves are compared, of rows whose hash occurs
    more than once only; different keys of one hash part ways there. The repeated hashes
    are stored, so that Spark knows their size before it plans the second scan: it
    broadcasts them if they are few, and then moves no other row. Hashes do not see
    which texts a collation of a language holds equal, so such keys are compared at once.
    """
    if not set(_collated(df, keys).values()) <= FOLDS.keys():
        return duplicate_keys(df, keys)
    equal = [folded(F.col(k), df.schema[k].dataType) for k in keys]
    hashed = df.select(*keys, row_hash(equal).alias("key_hash"))
    counts = hashed.groupBy("key_hash").agg(F.count("*").alias("rows"))
    repeated = workspace.write(counts.filter("rows > 1").select("key_hash"), "repeated_hashes")
    return duplicate_keys(hashed.join(repeated, "key_hash", "left_semi").select(*keys), keys)
