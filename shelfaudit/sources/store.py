"""Run-scoped tables and the published report table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfaudit.sources.files import drop_all_but, hadoop_path, point, pointed

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it."""
    folder = spark.conf.get(_CHECKPOINT_DIR, None)
    if not folder:
        raise ValueError(f"set {_CHECKPOINT_DIR} to a folder every executor can reach")
    return folder.rstrip("/")


def report_folder(spark: SparkSession, table: str) -> str:
    """Where a table that outlives the run is kept unless the caller names a place:
    a folder of its own in the warehouse."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}"


def _quoted(table: str) -> str:
    """A one- to three-part name for SQL, whatever characters its parts hold."""
    return table if "`" in table else ".".join(f"`{part}`" for part in table.split("."))


class Workspace:
    """A folder of its own for one run's tables, so that a run that died cannot
    get in the way of the next. Leaving the ``with`` block drops it."""

    def __init__(self, spark: SparkSession, base: str | None = None):
        self.spark = spark
        self.path = f"{(base or shared_folder(spark)).rstrip('/')}/run-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Store a DataFrame as Parquet and return the stored copy.

        The copy outlives lost executors and does not follow later changes of
        its source, which a cached DataFrame would when recomputed.
        """
        target = f"{self.path}/{name}"
        df.write.parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def drop(self) -> None:
        path, files = hadoop_path(self.spark, self.path)
        files.delete(path, True)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *exc) -> None:
        self.drop()


def snapshot(df: DataFrame, workspace: Workspace, name: str = "snapshot") -> DataFrame:
    """Freeze a table so that every check sees one version of it. A map-only
    copy of the selected columns."""
    return workspace.write(df, name)


def _new_version(df: DataFrame, location: str, schema: T.StructType) -> str:
    """Write a report to a new folder below ``location``, check it, return its name."""
    name = f"version-{uuid.uuid4().hex}"
    target = f"{location.rstrip('/')}/{name}"
    shaped = df.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])
    sent = Observation()
    shaped.observe(sent, F.count(F.lit(1)).alias("rows")).write.parquet(target)
    stored = df.sparkSession.read.schema(schema).parquet(target).count()
    if stored != sent.get["rows"]:
        raise RuntimeError(f"{target} holds {stored} rows, {sent.get['rows']} were written")
    return name


def publish_files(df: DataFrame, location: str, schema: T.StructType, keep: int = 2) -> DataFrame:
    """Replace the report at ``location`` without a catalog: write a new version, check
    it, then point at it. Readers (``read_published``) see the old report or the new one.
    The newest ``keep`` versions stay for readers that have begun."""
    spark, location = df.sparkSession, location.rstrip("/")
    name = _new_version(df, location, schema)
    point(spark, location, name, keep)
    drop_all_but(spark, location, "version-", max(1, keep), [name])
    return read_published(spark, location, schema)


def read_published(spark: SparkSession, location: str, schema: T.StructType) -> DataFrame:
    """The report that ``location`` points at."""
    name = pointed(spark, location.rstrip("/"))
    if name is None:
        raise ValueError(f"nothing has been published to {location}")
    return spark.read.schema(schema).parquet(f"{location.rstrip('/')}/{name}")


def publish(df: DataFrame, table: str, location: str, schema: T.StructType) -> DataFrame:
    """Replace a report table's contents and return the table.

    Every call writes a new folder below ``location``, checks it, and only
    then points the table at it. Readers see the old report or the new one,
    and a failure part-way leaves the old one in place. Older folders stay until
    ``drop_old_versions``. The table's catalog must be able to move a table.
    """
    spark = df.sparkSession
    target = f"{location.rstrip('/')}/{_new_version(df, location, schema)}"
    table = _quoted(table)
    place = target.replace("\\", "\\\\").replace("'", "\\'")
    if spark.catalog.tableExists(table):
        declared = [(f.name, f.dataType) for f in spark.table(table).schema]
        if declared != [(f.name, f.dataType) for f in schema]:
            raise ValueError(f"{table} is declared with other columns than the report")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")
    else:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{place}'")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def drop_old_versions(spark: SparkSession, location: str, keep: int = 1) -> int:
    """Delete all but the newest ``keep`` versions below a published table's
    location, and return how many went. Call it when no reader is left on them."""
    return drop_all_but(spark, location, "version-", max(1, keep))
