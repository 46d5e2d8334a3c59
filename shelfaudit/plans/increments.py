"""Summaries that are kept between runs and follow a table's files.

A summary is additive, so it is the sum of the summaries of the table's files. The store
has the bit slices of every file, the numbers of all items, and a manifest of the files
they are of, with sizes and times. An update lists the table, reads only files that the
manifest does not have as they are now, and writes slices of these; slices of files that
are gone or were replaced are left out by a join with the new manifest. What has been
written counts only when the store points at it, so an update that dies changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfaudit.config import DEFAULT, QcConfig
from shelfaudit.operators.item_bits import bit_slices, bit_summary, item_numbers
from shelfaudit.operators.summary import Summary
from shelfaudit.sources.files import drop_all_but, listing, path_of_rows, point, pointed
from shelfaudit.sources.tables import pricing_table

FILE = ["path", "length", "modified"]


class SummaryStore:
    """``folder`` lies in a place that all executors share and outlives the runs."""

    def __init__(self, spark: SparkSession, folder: str, config: QcConfig = DEFAULT):
        self.spark, self.folder, self.config = spark, folder.rstrip("/"), config

    def _state(self) -> dict | None:
        """What the store points at, if it was made with the same choices."""
        text = pointed(self.spark, self.folder)
        state = json.loads(text) if text else None
        return state if state and state["config"] == repr(self.config) else None

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def _write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self._read(name)

    def update(
        self, path: str, shape: Callable[[DataFrame], DataFrame] = pricing_table
    ) -> tuple[Summary, int]:
        """Bring the store up to date with the table at ``path`` and return its summary
        and how many files were read. ``shape`` gives a table the pricing columns. The
        names of the files to read pass through the driver, as for any scan."""
        run, state = f"run-{uuid.uuid4().hex}", self._state()
        # Stored first: what is read and what the manifest says are of one listing.
        files = self._write(listing(self.spark, [path]), f"{run}/files")
        if state:
            kept = self._read(state["manifest"])
            changed = files.join(kept, FILE, "left_anti")
            known = self._read(state["numbers"])
        else:
            kept, changed, known = None, files, None
        paths = [r.path for r in changed.select("path").collect()]
        unchanged = kept.join(files, FILE, "left_semi") if kept is not None else None
        if not paths and state and unchanged.count() == kept.count():
            drop_all_but(self.spark, self.folder, run, 0)
            return self.summary(), 0
        manifest = changed.select(*FILE, F.lit(run).alias("run"))
        if unchanged is not None:
            manifest = unchanged.unionByName(manifest)
        if paths:
            table = self.spark.read.option("basePath", path).parquet(*paths)
            rows = shape(table)
            numbers = self._write(item_numbers(rows, known), f"{run}/numbers")
            rows = rows.withColumn("_path", path_of_rows())
            bits = bit_slices(rows, numbers, numbers.count(), self.config, ("_path",))
            self._write(bits, f"{run}/bits")
        self._write(manifest, f"{run}/manifest")
        new = {
            "config": repr(self.config),
            "manifest": f"{run}/manifest",
            "numbers": f"{run}/numbers" if paths else state["numbers"],
        }
        point(self.spark, self.folder, json.dumps(new))
        return self.summary(), len(paths)

    def bits(self) -> DataFrame:
        """The bit slices of all files of the table as it was at the last update."""
        state = self._state()
        if state is None:
            raise ValueError(f"{self.folder} has no summary with these choices")
        manifest = self._read(state["manifest"]).select("run", F.col("path").alias("_path"))
        runs = [r.run for r in manifest.select("run").distinct().collect()]
        parts = [self._read(f"{r}/bits").withColumn("run", F.lit(r)) for r in sorted(runs)]
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
        return found.join(manifest, ["run", "_path"], "left_semi").drop("run", "_path")

    def summary(self) -> Summary:
        return bit_summary(self.bits())

    def drop_unused(self) -> int:
        """Delete what no file of the last update is of; returns how many runs went."""
        state = self._state()
        if state is None:
            return 0
        used = {r.run for r in self._read(state["manifest"]).select("run").distinct().collect()}
        used |= {state[k].split("/")[0] for k in ("manifest", "numbers")}
        return drop_all_but(self.spark, self.folder, "run-", 0, sorted(used))
