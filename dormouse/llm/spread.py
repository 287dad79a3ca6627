"""Global orders and prefix sums over tables of any size, and tables kept in the shared folder."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dormouse.llm.bytetext import forget

# Whether a query's shuffle files go when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def kept(df: DataFrame, varied: Sequence[str] = ()) -> DataFrame:
    """The same rows, computed once and written as Parquet below the cluster's shared folder.

    Columns of ``varied`` hold hardly a value twice and are written as they are, as no dictionary of theirs
    would be kept. The folder is ``spark.checkpoint.dir``, whose owner clears it as for checkpoints. Only a session
    that names none, as in tests on one machine, gets one of its own.
    """
    spark = df.sparkSession
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = tempfile.mkdtemp(prefix="checkpoints-")
        spark.conf.set("spark.checkpoint.dir", shared)
    path = f"{shared.rstrip('/')}/table-{uuid.uuid4().hex}"
    # Nothing reads the write's shuffles once it has ended, so they need not wait for the driver's garbage
    # collection. A table that is read again is read from its files.
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        plain = {f"parquet.enable.dictionary#{name}": "false" for name in varied}
        df.write.options(**plain).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before) if before is not None else spark.conf.unset(SHUFFLE_CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def named(df: DataFrame) -> str:
    """The columns as a schema string, for operators that pass them through Python."""
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema)


def in_tasks(df: DataFrame, work: Work, schema: str) -> DataFrame:
    """``mapInArrow``, after which a task's Python process gives back the memory it has freed.

    Python processes outlive their tasks, and would hold it while other stages run in the executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            forget()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
            if trim:
                trim(0)

    return df.mapInArrow(run, schema)


def all_columns(df: DataFrame) -> list[str]:
    """The columns for a select, also those with a dot in their name."""
    return [quoted(name) for name in df.columns]


def undotted(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table under names that Spark can pass to Python, and the new name of each column.

    Names with dots or backticks are the ones that change.
    """
    names: dict[str, str] = {}
    for name in df.columns:
        new = re.sub("[.`]", "_", name)
        while new != name and (new in df.columns or new in names.values()):
            new += "_"
        names[name] = new
    return df.toDF(*names.values()), names


def free_name(df: DataFrame, name: str) -> str:
    """The name, or the name with as many underscores as make it new to the table."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_order(df: DataFrame, order: list[str], part: str = "_part") -> DataFrame:
    """The rows dealt into ranges of ``order``; column ``part`` numbers the ranges. Kept.

    ``order`` should tell rows apart: equal rows all go to one range.
    """
    dealt = df.repartitionByRange(partitions(df.sparkSession), *order)
    return kept(dealt.withColumn(part, F.spark_partition_id()))


def prefix_sums(df: DataFrame, order: list[str], sums: dict[str, Column]) -> DataFrame:
    """Adds, for each entry of ``sums``, the total of that column over all rows before the row.

    Rows are dealt into ranges, every range is summed by itself, and the totals of the ranges
    before it are added. Only those totals, one row for each range, meet in one task.
    """
    rows = in_order(df, order)
    totals = rows.groupBy("_part").agg(*(F.sum(c).alias(f"_all_{n}") for n, c in sums.items()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "_part", *(F.coalesce(F.sum(f"_all_{n}").over(before), F.lit(0)).alias(f"_at_{n}") for n in sums)
    )
    inside = (
        Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row for each range, and as many ranges as shuffle partitions: its size is set by a setting.
    placed = rows.join(F.broadcast(starts), "_part")
    return placed.select(
        *all_columns(df),
        *(
            (F.col(f"_at_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(n)
            for n, c in sums.items()
        ),
    )
