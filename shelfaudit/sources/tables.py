"""Reading the input tables into the package's column names and types."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfaudit import schema as S


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A Parquet path, or a catalog table with a one- to three-part name."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def _measure(name: str, col: Column, kind: T.DataType, measure: T.DecimalType) -> Column:
    """A measure as a decimal. Decimals keep their own scale; other types become
    ``measure``, and a value that would change by that ends the run."""
    if isinstance(kind, T.DecimalType):
        return col
    wide = "double" if isinstance(kind, T.FractionalType) else "decimal(38,18)"
    exact = col.cast(wide)
    cast = exact.cast(measure)
    lost = F.raise_error(
        F.concat(F.lit(f"{name} has a value that {measure.simpleString()} rounds: "), col.cast("string"))
    )
    return F.when(cast.cast(wide) != exact, lost.cast(measure)).otherwise(cast)


def _shaped(
    df: DataFrame, schema: T.StructType, source: Mapping[str, str], measure: T.DecimalType
) -> DataFrame:
    def column(field: T.StructField) -> Column:
        col = df[f"`{source[field.name]}`"]
        if isinstance(field.dataType, T.DecimalType):
            kind = df.select(col).schema[0].dataType
            return _measure(field.name, col, kind, measure)
        return col.cast(field.dataType)

    return df.select([column(f).alias(f.name) for f in schema])


def raw_pricing_table(
    df: DataFrame,
    source: Mapping[str, str] = S.RAW_PRICING_SOURCE,
    measure: T.DecimalType = S.MONEY,
) -> DataFrame:
    """A vendor feed in package form; ``source`` maps our names to the feed's.

    Decimal measures stay as they are. ``measure`` is the type of those that the
    feed holds as text or as floating-point or whole numbers.
    """
    return _shaped(df, S.RAW_PRICING, source, measure)


def pricing_table(
    df: DataFrame,
    source: Mapping[str, str] = S.PRICING_SOURCE,
    measure: T.DecimalType = S.MONEY,
) -> DataFrame:
    """A pricing table in package form; see ``raw_pricing_table``."""
    return _shaped(df, S.PRICING, source, measure)


def with_collation(df: DataFrame, collation: str, columns: Iterable[str]) -> DataFrame:
    """Compare and group the columns by a collation, for example
    ``UTF8_LCASE_RTRIM`` to ignore case and trailing blanks."""
    return df.withColumns({c: F.collate(F.col(c), collation) for c in columns})
