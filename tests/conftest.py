from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from dormouse.session import apply_settings  # noqa: E402
from dormouse.sources.schemas import TRACKER, WIKI  # noqa: E402
from dormouse.sources.tables import from_parquet  # noqa: E402
from sample.tables import DERIVATIONS, Sample  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield apply_settings(session)
    session.stop()


@pytest.fixture
def settings(spark):
    """Sets session settings for one test."""
    before = {}

    def change(**values):
        for name, value in values.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture(scope="session")
def exported(spark, tmp_path_factory):
    """The derived sample tables as an export of the source databases would look."""
    root = tmp_path_factory.mktemp("export")
    sample = Sample(spark, SMALL)
    for name, derive in DERIVATIONS.items():
        derive(sample).write.parquet(f"{root}/{name}")
    return str(root)


@pytest.fixture(scope="session")
def tracker_files(spark, exported):
    return from_parquet(spark, exported, TRACKER, {name: name for name in TRACKER})


@pytest.fixture(scope="session")
def wiki_files(spark, exported):
    return from_parquet(spark, exported, WIKI, {name: name for name in WIKI})
