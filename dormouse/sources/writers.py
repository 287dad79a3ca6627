"""Writing results, and tables in layouts that later reads profit from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ordered results are lists for people to read; each slice is one file of them.
SLICES = 16
_SLICE = "slice"


def write_table(table: DataFrame, path: str) -> DataFrame:
    """Write to a new path and give the table back as read from there.

    The result no longer depends on the work that made it, so a lost executor
    cannot set that work going again, and later readers see the same rows.
    """
    table.write.mode("errorifexists").parquet(path)
    return table.sparkSession.read.parquet(path)


def write_by_value(table: DataFrame, path: str, column: str, *key: str) -> DataFrame:
    """Write a folder for each value of the column, rows in the order of the key.

    Readers that ask for one value open its folder only, and those that ask for a range of the key
    skip files and row groups by their bounds. Rows are dealt into ranges of value and key, so a
    value that a third of all rows have is spread over as many files as the rest. A null is a value;
    an empty text is read back as a null.
    """
    dealt = table.repartitionByRange(column, *key).sortWithinPartitions(column, *key)
    dealt.write.partitionBy(column).mode("errorifexists").parquet(path)
    kinds = table.schema
    return table.sparkSession.read.schema(kinds).parquet(path).select(*table.columns)


def write_in_order(table: DataFrame, path: str, *order: Column | str, slices: int = SLICES) -> None:
    """Write the rows in ranges of the order, sorted within, as numbered folders of one file each.

    ``read_in_order`` gives them back sorted without sorting again.
    """
    # Orders that mean the null's place have to be columns, which ranges and sorts both respect.
    dealt = table.repartitionByRange(slices, *order).withColumn(_SLICE, F.spark_partition_id())
    # With the slice first, the writer does not sort again by it.
    dealt.sortWithinPartitions(_SLICE, *order).write.partitionBy(_SLICE).mode("errorifexists").parquet(path)


def read_in_order(spark: SparkSession, path: str, kinds: T.StructType) -> DataFrame:
    """The rows that ``write_in_order`` wrote, in their order; ``kinds`` is their schema.

    Slices follow each other as parts of a union do; within a file Spark reads from begin to end.
    """
    whole = spark.read.schema(T.StructType([*kinds, T.StructField(_SLICE, T.IntegerType())])).parquet(path)
    numbers = sorted(row[0] for row in whole.select(_SLICE).distinct().collect())
    if not numbers:
        return whole.drop(_SLICE)
    return reduce(DataFrame.union, (spark.read.schema(kinds).parquet(f"{path}/{_SLICE}={n}") for n in numbers))
