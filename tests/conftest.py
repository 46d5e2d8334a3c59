from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from shelfaudit import schema as S

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.sql.debug.maxToStringFields", "1000")
        .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
        .config("spark.checkpoint.dir", str(scratch / "shared"))
        .config("spark.local.dir", str(scratch / "local"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


_PRICING_DEFAULTS = {
    "market_name": "M", "time_period": "2020-01-01 QTR", "upc": "1", "condition": "R",
    "units": "20", "dollars": "100", "market_units": "5", "market_dollars": "30",
    "price_weighted_volume": "50", "kvi_quad": "KVI", "outlier_flag": "Normal",
}
_RAW_DEFAULTS = {
    "market_name": "M", "time_period": "QTR 2020-01-01", "upc": "1",
    "units": "20", "comp_units": "5", "dollars": "100", "comp_dollars": "30",
}


def _rows(spark, defaults, schema, rows):
    text = ", ".join(f"{n} string" for n in defaults)
    full = [{**defaults, **r} for r in rows]
    df = spark.createDataFrame([tuple(r[n] for n in defaults) for r in full], text)
    return df.select([df[f.name].cast(f.dataType) for f in schema])


@pytest.fixture(scope="session")
def pricing(spark):
    """Build a pricing table from rows that name only what matters."""
    return lambda *rows: _rows(spark, _PRICING_DEFAULTS, S.PRICING, rows)


@pytest.fixture(scope="session")
def raw(spark):
    return lambda *rows: _rows(spark, _RAW_DEFAULTS, S.RAW_PRICING, rows)
