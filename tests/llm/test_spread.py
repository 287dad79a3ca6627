from __future__ import annotations

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from dormouse.llm.spread import SHUFFLE_CLEANUP, kept


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {file for folder in folders for file in Path(folder).rglob("shuffle_*.data")}


@pytest.mark.parametrize("setting", [None, "false"])
def test_a_kept_table_leaves_no_shuffle_files_and_the_setting_as_it_was(spark, settings, setting):
    if setting is not None:
        settings(spark__sql__classic__shuffleDependency__fileCleanup__enabled=setting)
    before, old = spark.conf.get(SHUFFLE_CLEANUP, None), shuffle_files(spark)
    found = kept(spark.range(50_000).groupBy((F.col("id") % 10_000).alias("k")).agg(F.count(F.lit(1)).alias("n")))
    for _ in range(40):  # files go in the background
        if not shuffle_files(spark) - old:
            break
        time.sleep(0.25)
    assert not shuffle_files(spark) - old
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
    assert found.agg(F.sum("n"), F.count("k")).first()[:] == (50_000, 10_000)
    with pytest.raises(Exception):
        kept(spark.range(1).select(F.raise_error(F.lit("no"))))
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
