"""Time the checks and print one JSON line.

The reports read tables in practice, so the joined test data is first written
out as tables. That step is timed as ``stage_inputs`` and counts towards the
total. Each figure is the best of ``BENCH_REPEATS`` runs after an untimed one.
``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from shelfaudit.config import CHARACTERS, QcConfig
from shelfaudit.operators import back_data, coverage, duplication, hygiene, index, trend
from shelfaudit.plans import suite
from shelfaudit.sources import fixtures

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
FOCUS = QcConfig(focus_markets=tuple(fixtures.FOCUS_MARKETS))


def build_session(scratch: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        # The default of 100 holds fewer classes than one round compiles.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .config("spark.local.dir", f"{scratch}/local")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = build_session(scratch)
    seconds: dict[str, float] = {}

    def timed(name, action):
        start = time.perf_counter()
        out = action()
        took = round(time.perf_counter() - start, 3)
        seconds[name] = min(took, seconds.get(name, took))
        return out

    def stage(folder: str, sf_dir: str) -> dict[str, DataFrame]:
        names = ("raw_pricing", "pricing_prior", "pricing_current", "codes")
        for name in names:
            getattr(fixtures, name)(spark, sf_dir).write.parquet(f"{folder}/{name}")
        return {name: spark.read.parquet(f"{folder}/{name}") for name in names}

    def checks(t: dict[str, DataFrame], sf_dir: str):
        raw, prior, current = t["raw_pricing"], t["pricing_prior"], t["pricing_current"]
        return {
            "duplication_check": lambda: run(duplication.duplication_check(current)),
            "coverage_check": lambda: run(coverage.coverage_check(raw, current, FOCUS)),
            "period_condition_metrics": lambda: run(
                back_data.period_condition_metrics(current, "current")
            ),
            "back_data_check": lambda: run(back_data.back_data_check(prior, current)),
            "period_counts": lambda: run(index.period_counts(current)),
            "store_index": lambda: run(index.store_index(current)),
            "index_report": lambda: run(index.index_report(current)),
            "trend_check": lambda: run(trend.trend_check(index.index_report(current), 0.05)),
            "char_profile": lambda: run(hygiene.char_profile(t["codes"], "upc")),
            "char_profile_documents": lambda: run(
                hygiene.char_profile_summary(
                    spark.read.parquet(f"{sf_dir}/documents.parquet"), "text", CHARACTERS
                )
            ),
            "strip_chars": lambda: run(hygiene.strip_chars(t["codes"], "original_upc", "upc")),
            "qc_suite": lambda: run(
                suite.run_qc_suite(
                    raw, prior, current, f"qc_index_{uuid.uuid4().hex}", FOCUS
                )["index"]
            ),
        }

    for action in checks(stage(f"{scratch}/warm", SF_DIR), SF_DIR).values():
        action()
    for i in range(REPEATS):
        tables = timed("stage_inputs", lambda: stage(f"{scratch}/tables-{i}", SF_DIR))
        for name, action in checks(tables, SF_DIR).items():
            timed(name, action)

    print(
        json.dumps(
            {
                "metric": "total seconds of the quality checks",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows": {n: df.count() for n, df in tables.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
