"""What filters do together: survivors, removals and losses of every order.

Each filter has a table of the ids that fail it. A filter's failing ids that survive a
prefix of other filters are what it removes behind that prefix; a prefix that grows by
a filter is a left-anti join with that filter's table, and the ids that this join drops,
found by the left-semi join, fail the later filter in vain: they are redundant there. As
the order within a prefix does not matter, prefixes are sets and grow in the order of
the letters: five rounds of joins on the id give all of them at once. The survivors of
an order are a part's documents less what its steps removed.

A document is a row: rows have a number of their own, so shared and null ids count each.

Defined results: null texts are empty; of several labels of an id 1 counts, and null ids
have none; a document fails `copies` if its text is that of a row with a smaller id, null
ids being the largest; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import itertools
import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, cut, documents

LEAST_WORDS = 100
DISTINCT_PERCENT = 80
CAPITALS_PERCENT = 10
SYMBOLS = r"[#$%&*|]"
SALTS = 16
LETTERS = "ABCDE"
CAPITALS = "".join(map(chr, range(65, 91)))


def text_failures(text: Column) -> dict[str, Column]:
    """The filters A to D, each true where the text fails."""
    inner = F.btrim(text, F.lit(BLANKS))
    words = F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, r"[\x20\x09-\x0D]+")
    )
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words),
        "C": 100 * capitals > CAPITALS_PERCENT * F.length(text),
        "D": text.rlike(SYMBOLS),
    }


def copies(rows: DataFrame) -> Column:
    """Whether a row joined by `with_least` is a copy of a row of smaller id."""
    return F.col("least").isNotNull() & F.coalesce(F.col("doc_id") > F.col("least"), F.lit(True))


def with_least(rows: DataFrame) -> DataFrame:
    """`rows` (row, doc_id, hash) with least: the smallest id of equal texts, null
    where no other row has the text or all ids are null. Texts are told apart by
    SHA-256. A text of many rows is spread over SALTS tasks."""
    repeated = rows.groupBy("hash").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("times")
    )
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    repeated = repeated.filter("times > 1").select("hash", "least", salts)
    salted = rows.withColumn("salt", (F.col("row") % SALTS).cast("int"))
    return salted.join(repeated, ["hash", "salt"], "left").drop("hash", "salt")


def failing_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """row, part, good, toxic (0 or 1) and a boolean for each filter."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("hash"),
        *[fails.alias(letter) for letter, fails in text_failures(text).items()],
    )
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    found = with_least(cut(rows)).join(known, "doc_id", "left").na.fill(0, ["good", "toxic"])
    return cut(found.withColumn("E", copies(found)).drop("doc_id", "least"))


def removals(rows: DataFrame, letters: str) -> DataFrame:
    """part, filter (its number), prefix (a set of other filters, by bits), vain, n,
    good, toxic. Not vain: the rows that the filter removes behind the prefix. Vain: the
    failing rows that the prefix's last filter, in the order of `letters`, is the first
    to remove. A round takes every row once as it is and once with a longer prefix."""
    fails = [cut(rows.filter(x).select("row")) for x in letters]
    numbers = F.filter(
        F.array(*[F.when(F.col(x), F.lit(i)) for i, x in enumerate(letters)]), lambda i: i.isNotNull()
    )
    columns = ["filter", "prefix", "vain", "row", "part", "good", "toxic"]
    found = rows.withColumn("filter", F.explode(numbers))
    found = found.withColumns({"prefix": F.lit(0), "vain": F.lit(False)}).select(columns)
    for i, failing in enumerate(fails):
        grows = (F.col("filter") != i) & ~F.col("vain")
        both = F.when(grows, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
        taken = found.withColumn("longer", F.explode(both))
        ids = failing.withColumn("longer", F.lit(True))
        stay = taken.join(ids, ["row", "longer"], "left_anti")
        gone = taken.join(ids, ["row", "longer"], "left_semi").withColumn("vain", F.lit(True))
        longer = F.col("prefix") + F.when(F.col("longer"), 1 << i).otherwise(0)
        found = cut(stay.unionByName(gone).withColumn("prefix", longer).select(columns))
    return found.groupBy("part", "filter", "prefix", "vain").agg(
        F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )


def orders(letters: str) -> list[dict]:
    """Of each step of each order: its filter and prefix as a cell's number, the cells
    of the steps so far, the cells that the semi joins gave on the way to its prefix,
    the cell behind all other filters, and the cells of this filter's step in every
    order."""
    n = len(letters)
    every = (1 << n) - 1
    found = []
    for order in itertools.permutations(range(n)):
        steps = [_cell(x, sum(1 << y for y in order[:i])) for i, x in enumerate(order)]
        for i, x in enumerate(order):
            way = itertools.accumulate(sorted(1 << y for y in order[:i]))
            found.append(
                {
                    "filter_order": "".join(letters[y] for y in order),
                    "step": i + 1,
                    "cell": steps[i],
                    "so_far": steps[: i + 1],
                    "on_the_way": [_cell(x, prefix) for prefix in way],
                    "alone": _cell(x, every - (1 << x)),
                    "filter": x,
                }
            )
    return found


STEP = (
    "array<struct<filter_order: string, step: int, cell: int, so_far: array<int>, "
    "on_the_way: array<int>, alone: int, filter: int>>"
)
CELL = 1 << 10  # more than there are sets of filters
DOCUMENTS = -1  # the cell of all documents


def _cell(number, prefix):
    return number * CELL + prefix


def audit(rows: DataFrame, letters: str = LETTERS) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley, for all orders of the filters. `rows` are stored: row, part,
    good, toxic and a boolean column for each filter."""
    counts = removals(rows, letters)
    zero = F.lit(0).cast("long")
    documents = rows.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.lit(DOCUMENTS).alias("cell"), F.lit(False).alias("vain"), "n",
        zero.alias("good"), zero.alias("toxic"), zero.alias("shapley"), zero.alias("filter"),
    )
    size = F.bit_count("prefix").cast("int")
    times = F.factorial(size) * F.factorial(F.lit(len(letters) - 1) - size)
    cells = counts.select(
        "part", _cell(F.col("filter"), F.col("prefix")).alias("cell"), "vain", "n", "good", "toxic",
        F.when(F.col("vain"), 0).otherwise(F.col("n") * times).alias("shapley"), "filter",
    ).unionByName(documents)
    # A row for each part, whose maps have a cell for each filter and set of others.
    value = F.struct("cell", F.struct("n", "good", "toxic", "shapley", "filter"))
    of_part = cells.groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.when(~F.col("vain"), value))).alias("removed"),
        F.map_from_entries(F.collect_list(F.when(F.col("vain"), F.struct("cell", "n")))).alias("vain"),
    )
    steps = F.from_json(F.lit(json.dumps(orders(letters))), STEP)
    found = of_part.withColumn("s", F.explode(steps))

    def of(cell: Column, field: str) -> Column:
        return F.coalesce(F.col("removed")[cell][field], zero)

    def total(cells: Column, value) -> Column:
        return F.aggregate(cells, zero, lambda sum_, cell: sum_ + value(cell))

    own = F.filter(F.map_values("removed"), lambda v: v["filter"] == F.col("s.filter"))
    return found.select(
        "part",
        "s.filter_order",
        "s.step",
        (of(F.lit(DOCUMENTS), "n") - total(F.col("s.so_far"), lambda c: of(c, "n"))).alias("kept"),
        of(F.col("s.cell"), "n").alias("removed"),
        total(F.col("s.on_the_way"), lambda c: F.coalesce(F.col("vain")[c], zero)).alias("redundant"),
        of(F.col("s.alone"), "n").alias("unique_fails"),
        of(F.col("s.cell"), "good").alias("good_lost"),
        of(F.col("s.cell"), "toxic").alias("toxic_lost"),
        F.aggregate(own, zero, lambda sum_, v: sum_ + v["shapley"]).alias("shapley"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return audit(failing_documents(documents(spark, sf_dir), labels))


ORACLE = r"""
WITH RECURSIVE
texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
known AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
  FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (len(words) < 100)::INT
         + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
         + 4 * (100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * len(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * coalesce(coalesce(d.doc_id, 9223372036854775807) >
                         min(d.doc_id) OVER (PARTITION BY t), false)::INT AS fails
  FROM texts d LEFT JOIN known l ON l.doc_id = d.doc_id),
groups AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
prefixes AS (
  SELECT letter AS o, letter, bit, 0 AS earlier, 1 AS step FROM letters
  UNION ALL
  SELECT o || l.letter, l.letter, l.bit, earlier + p.bit, step + 1
  FROM prefixes p, letters l WHERE (earlier + p.bit) & l.bit = 0),
orders AS (SELECT o AS filter_order FROM prefixes WHERE step = 5),
cells AS (
  SELECT part, filter_order, step, p.letter, g.n, g.good, g.toxic,
         fails & (earlier + bit) = 0 AS stays, fails & bit > 0 AND fails & earlier = 0 AS goes,
         fails & bit > 0 AND fails & earlier > 0 AS vain, fails = bit AS alone
  FROM orders JOIN prefixes p ON starts_with(filter_order, o), groups g),
steps AS (
  SELECT part, filter_order, step, letter,
         coalesce(sum(n) FILTER (stays), 0) AS kept, coalesce(sum(n) FILTER (goes), 0) AS removed,
         coalesce(sum(n) FILTER (vain), 0) AS redundant,
         coalesce(sum(n) FILTER (alone), 0) AS unique_fails,
         coalesce(sum(good) FILTER (goes), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (goes), 0) AS toxic_lost
  FROM cells GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley
FROM steps
"""
