"""The files of a table: which they are, whether they changed, which version counts.

Only names, sizes and times are read here, as Spark itself does when it plans a scan.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "pointer-"


class InputChanged(RuntimeError):
    """A pinned table is no longer what it was when the run began."""


def hadoop_path(spark: SparkSession, folder: str):
    """The folder in Hadoop's file API, which PySpark offers only through the JVM;
    so this needs a classic session, not Spark Connect."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def plain_path(path: Column) -> Column:
    """A path with one slash behind its scheme, as Spark writes it in either way."""
    return F.regexp_replace(path, "^([A-Za-z0-9]+):/+", "$1:/")


def path_of_rows() -> Column:
    """The file that a row was read from, as ``listing`` names it. The hidden column has
    special characters as in a URL, in which a plus sign stays one."""
    path = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return plain_path(F.url_decode(path))


def listing(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path, length, modified of each file below the paths; no file is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return found.select(
        plain_path(F.col("path")).alias("path"), "length", F.col("modificationTime").alias("modified")
    )


class Pin:
    """The version of a table of files that a DataFrame reads.

    Spark fixes the list of files when the DataFrame is made, so every query on it
    reads the same files, and files added later are not part of the version. What a
    list cannot keep out is a file that is replaced or deleted: ``verify`` compares
    sizes and times and raises ``InputChanged``. Call it when all reading is done.
    """

    def __init__(self, df: DataFrame):
        self._spark = df.sparkSession
        self._paths = [unquote(p) for p in df.inputFiles()]
        if not self._paths:
            raise ValueError("only a table of files can be pinned")
        self._files = self._now()

    def _now(self) -> dict[str, tuple]:
        rows = listing(self._spark, self._paths).collect()
        return {r.path: (r.length, r.modified) for r in rows}

    def verify(self) -> None:
        try:
            now = self._now()
        except AnalysisException as gone:
            raise InputChanged(f"a file of the table is gone: {gone}") from gone
        changed = sorted(p for p in self._files if self._files[p] != now.get(p))
        if changed:
            raise InputChanged(f"{len(changed)} files of the table changed, such as {changed[0]}")


def _pointers(spark: SparkSession, folder: str) -> list[str]:
    path, files = hadoop_path(spark, folder)
    if not files.exists(path):
        return []
    names = (x.getPath().getName() for x in files.listStatus(path))
    return sorted(n for n in names if n.startswith(POINTER))


def pointed(spark: SparkSession, folder: str) -> str | None:
    """What the newest pointer of a folder says; None without one."""
    found = _pointers(spark, folder)
    if not found:
        return None
    path, files = hadoop_path(spark, f"{folder}/{found[-1]}")
    stream = files.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def point(spark: SparkSession, folder: str, text: str, keep: int = 2) -> None:
    """Make ``text`` what the folder points at.

    The pointer is written aside and comes into place, whole, by a rename; readers
    take the one with the highest number. Needs no catalog. A second writer that took
    the same number meanwhile makes this fail. Older pointers go but for ``keep``.
    """
    found = _pointers(spark, folder)
    number = int(found[-1][len(POINTER) :]) + 1 if found else 1
    aside, files = hadoop_path(spark, f"{folder}/.new-{uuid.uuid4().hex}")
    place, _ = hadoop_path(spark, f"{folder}/{POINTER}{number:09d}")
    stream = files.create(aside)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if files.exists(place) or not files.rename(aside, place):
        files.delete(aside, False)
        raise RuntimeError(f"{folder} was pointed elsewhere by another run")
    for old in found[: max(0, len(found) + 1 - max(1, keep))]:
        files.delete(hadoop_path(spark, f"{folder}/{old}")[0], False)


def drop_all_but(spark: SparkSession, folder: str, prefix: str, keep: int, spare: Sequence[str] = ()) -> int:
    """Delete all folders below ``folder`` that begin with ``prefix`` but for the newest
    ``keep`` and those named in ``spare``; returns how many went."""
    path, files = hadoop_path(spark, folder)
    if not files.exists(path):
        return 0
    found = [x for x in files.listStatus(path) if x.getPath().getName().startswith(prefix)]
    found.sort(key=lambda x: x.getModificationTime(), reverse=True)
    old = [x.getPath() for x in found[max(0, keep) :] if x.getPath().getName() not in spare]
    for x in old:
        files.delete(x, True)
    return len(old)
