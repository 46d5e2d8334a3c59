"""Pricing tables derived from the star-schema test data.

They stand in for the vendor feed, the published table and its rebuilt
version; ``FIXTURES.md`` lists the defects planted in them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfaudit import schema as S
from shelfaudit.sources.store import Workspace

FOCUS_MARKETS = ["ASIA", "EUROPE"]


def _money(col: Column) -> Column:
    return col.cast(S.MONEY)


def _cents(col: Column) -> Column:
    """An amount of money as a whole number: sums of these need no decimals, which Spark
    adds up as objects from 19 digits on."""
    return (col * 100).cast("long")


def _whole(hundredths: Column) -> Column:
    """Rounded half away from zero, as a cast to ``MONEY`` does."""
    half = F.when(hundredths < 0, F.lit(-50)).otherwise(F.lit(50))
    return F.call_function("div", hundredths + half, F.lit(100))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Each large join feeds an exchange on another key, which leaves AQE free
    # to split a hot part, order or customer. Joining part last would put its
    # key under the group-by and rule that split out.
    # What belongs to a part or an order is computed there, once, before its
    # lines repeat it.
    parts = _table(spark, sf_dir, "part").select(
        "p_partkey",
        "p_size",
        _money(F.col("p_size") % 4).alias("cf"),
        (F.col("p_size") % 4).cast("long").alias("cf_whole"),
        _cents(_money(F.col("p_retailprice"))).alias("price_cents"),
    )
    lines = (
        _table(spark, sf_dir, "lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "l_orderkey",
            F.col("l_partkey").alias("item"),
            F.col("l_returnflag").alias("cond"),
            _money(F.col("l_quantity")).alias("q"),
            _money(F.col("l_extendedprice")).alias("v"),
            "p_size",
            "cf",
            "cf_whole",
            "price_cents",
        )
    )
    markets = (
        _table(spark, sf_dir, "customer")
        .join(_table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    orders = (
        _table(spark, sf_dir, "orders")
        .join(markets, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "o_orderkey",
            F.col("r_name").alias("mkt"),
            F.trunc(F.col("o_orderdate").cast("date"), "quarter").alias("qtr"),
        )
    )
    # Both sides grow with the data, so this is a shuffle join at any scale.
    return lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))


def raw_pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _base(spark, sf_dir).select(
        F.col("mkt").alias("market_name"),
        F.concat(F.lit("QTR "), F.col("qtr").cast("string")).alias("time_period"),
        F.col("item").cast("string").alias("upc"),
        F.col("q").alias("units"),
        _money(F.col("q") * F.col("cf")).alias("comp_units"),
        F.col("v").alias("dollars"),
        _money(F.col("v") * F.col("cf")).alias("comp_dollars"),
    )


GROUP = ["mkt", "qtr", "item", "cond"]


def _volumes() -> dict[str, Column]:
    """What a pricing table adds up, in cents."""
    units, dollars = _cents(F.col("q")), _cents(F.col("v"))
    return {
        "units": units,
        "dollars": dollars,
        "market_units": units * F.col("cf_whole"),
        "market_dollars": dollars * F.col("cf_whole"),
        "price_weighted_volume": _whole(units * F.col("price_cents")),
    }


def _total(cents: Column) -> Column:
    return _money(F.sum(cents).cast("decimal(20,0)") * F.lit("0.01").cast("decimal(2,2)"))


def _pricing(rows: DataFrame) -> DataFrame:
    totals = [_total(c).alias(n) for n, c in _volumes().items()]
    return _shaped(rows.groupBy(*GROUP).agg(*totals, F.max("p_size").alias("size")))


def _shaped(grouped: DataFrame) -> DataFrame:
    is_kvi = (F.col("size") <= 10) & (F.col("qtr") != F.lit("1999-01-01").cast("date"))
    ratio = F.col("dollars").cast("double") / F.col("price_weighted_volume").cast("double")
    return grouped.select(
        F.col("mkt").alias("market_name"),
        F.concat(F.col("qtr").cast("string"), F.lit(" QTR")).alias("time_period"),
        F.col("item").cast("string").alias("upc"),
        F.col("cond").alias("condition"),
        "units",
        "dollars",
        "market_units",
        "market_dollars",
        "price_weighted_volume",
        F.when(is_kvi, S.KVI).otherwise("Non-KVI").alias("kvi_quad"),
        F.when(F.col("item") % 50 == 0, F.lit(None).cast("string"))
        .when(ratio > 4, S.OUTLIER)
        .otherwise("Normal")
        .alias("outlier_flag"),
    )


def _lost_market() -> Column:
    return (F.col("qtr") == F.lit("1998-01-01").cast("date")) & (F.col("mkt") == "AFRICA")


def _kept() -> Column:
    """Whether the rebuilt table has a line; unknown where a filter would drop it."""
    year = F.year("qtr")
    lost = (
        ((year == 1996) & (F.col("l_orderkey") % 50 == 0))
        | ((year == 1997) & (F.col("l_orderkey") % 5 == 0))
        | _lost_market()
    )
    return ~lost


def _published() -> Column:
    return F.col("qtr") < F.lit("2001-07-01").cast("date")


def pricing_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rebuilt table: two thinned years and one lost market."""
    return _pricing(_base(spark, sf_dir).filter(_kept()))


def pricing_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published table: complete, but without the newest quarter."""
    return _pricing(_base(spark, sf_dir).filter(_published()))


def pricing_pair(spark: SparkSession, sf_dir: str, run: Workspace) -> tuple[DataFrame, DataFrame]:
    """``pricing_prior`` and ``pricing_current`` for reports that read them several
    times: the lines are joined and added up once, into one stored row for each group of
    either. Only in the thinned years do the lines that are kept have sums of their own;
    in the others a group is kept or lost as a whole."""
    thinned = F.coalesce(F.year("qtr").isin(1996, 1997), F.lit(True))
    kept = thinned & _kept()
    volumes = _volumes()
    both = run.write(
        _base(spark, sf_dir)
        .groupBy(*GROUP)
        .agg(
            *[_total(c).alias(n) for n, c in volumes.items()],
            *[_total(F.when(kept, c)).alias(f"kept_{n}") for n, c in volumes.items()],
            F.count_if(kept).alias("kept_lines"),
            F.max("p_size").alias("size"),
        ),
        "both",
    )
    own = {n: F.when(thinned, F.col(f"kept_{n}")).otherwise(F.col(n)) for n in volumes}
    is_kept = F.when(thinned, F.col("kept_lines") > 0).otherwise(~_lost_market())
    return _shaped(both.filter(_published())), _shaped(both.filter(is_kept).withColumns(own))


def pricing_swapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published table after an edit that no sum shows: in each group of the year
    1996 the first and the last item, by text, have changed places."""
    group = Window.partitionBy("market_name", "time_period", "condition")
    first, last = F.min("upc").over(group), F.max("upc").over(group)
    edited = (
        F.when(~F.col("time_period").startswith("1996"), F.col("upc"))
        .when(F.col("upc") == first, last)
        .when(F.col("upc") == last, first)
        .otherwise(F.col("upc"))
    )
    prior = pricing_prior(spark, sf_dir)
    return prior.withColumn("upc", edited).select(*prior.columns)


def raw_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with dates in two forms, and labels without a date for some items."""
    item = F.col("upc").cast("long")
    date = F.right("time_period", F.lit(10))
    slashed = F.concat(F.lit("QTR "), F.date_format(date.cast("date"), "MM/dd/yyyy"))
    label = F.when(item % 7 == 0, "QTR unknown").when(item % 3 == 0, slashed)
    return raw_pricing(spark, sf_dir).withColumn("time_period", F.coalesce(label, "time_period"))


def odd(current: DataFrame) -> DataFrame:
    """The dirty table, with labels without a date for some items."""
    unread = F.when(F.col("upc").cast("long") % 89 == 0, "unknown QTR")
    return dirty(current).withColumn("time_period", F.coalesce(unread, "time_period"))


def pricing_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd(pricing_current(spark, sf_dir))


def pricing_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rebuilt table with no price-weighted volume for some items."""
    zero = F.when(F.col("upc").cast("long") % 71 == 0, F.lit(0).cast(S.MONEY))
    current = pricing_current(spark, sf_dir)
    volume = F.coalesce(zero, "price_weighted_volume").cast(S.MONEY)
    return current.withColumn("price_weighted_volume", volume)


def pricing_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pricing_current`` with every 97th item's rows written twice."""
    return dirty(pricing_current(spark, sf_dir))


def dirty(current: DataFrame) -> DataFrame:
    twice = F.when(F.col("upc").cast("bigint") % 97 == 0, 2).otherwise(1)
    return current.withColumn("copy", F.explode(F.sequence(F.lit(1), twice))).drop("copy")


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names and numbers, most with one stray character appended."""
    # The character each remainder of the part key appends.
    stray = {0: 9, 1: 11, 2: 8, 3: 13, 4: 10, 5: 12, 6: 255, 7: 160}
    key = F.col("p_partkey")
    suffix = F.lit("")
    for remainder, code in stray.items():
        suffix = F.when(key % 9 == remainder, F.lit(chr(code))).otherwise(suffix)
    keep = key % 25 != 0
    return _table(spark, sf_dir, "part").select(
        F.when(keep, F.concat("p_name", suffix)).alias("original_upc"),
        F.when(keep, F.concat(key.cast("string"), suffix)).alias("upc"),
    )
