"""Balanced shards: the corpus in one order, cut where the bytes before a document pass equal targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dormouse.llm.spread import all_columns, prefix_sums, quoted

# Bytes that a document takes in a shard besides its text.
OVERHEAD_BYTES = 16


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of the text and its overhead; a null text has none of its own."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(OVERHEAD_BYTES)


def balanced_shards(rows: DataFrame, size: str, order: list[str], shards: int) -> DataFrame:
    """Adds ``shard`` and ``slot`` to rows, by contiguous ranges of ``order`` with near equal sizes.

    A row goes to the shard that holds the middle of its bytes, so no shard misses its target by
    more than half a row at either end. ``slot`` counts the rows of a shard from 0 without gaps.
    A size below 0 or null counts as 0. Rows that tie in ``order`` are told apart by where they
    were read; rows that are equal throughout are interchangeable. An empty table gives an empty
    result. With fewer rows than shards some shards stay empty. Columns named ``shard`` or ``slot``
    are replaced.
    """
    rows = rows.drop("shard", "slot")
    weight = F.greatest(F.coalesce(F.col(quoted(size)).cast("long"), F.lit(0)), F.lit(0))
    keys = [f"key{i}" for i in range(len(order))]
    # The rows' own columns travel as one, so that none clashes with those made here.
    packed = rows.select(
        F.struct(*all_columns(rows)).alias("own"),
        weight.alias("weight"),
        *(F.col(quoted(name)).alias(key) for name, key in zip(order, keys)),
        F.monotonically_increasing_id().alias("read"),
    )
    placed = prefix_sums(
        packed, [*keys, "read"], {"before": F.col("weight"), "place": F.lit(1).cast("long")}
    )
    total = placed.agg(F.max(F.col("before") + F.col("weight"))).scalar()
    # Twice the bytes before the middle of the row, against twice the total; whole up to 10^17 bytes.
    middle = (2 * F.col("before") + F.col("weight")) * shards
    cut = placed.withColumn("middle", middle).withColumn("twice", 2 * total)
    share = F.least(F.expr("middle div twice").cast("int"), F.lit(shards - 1))
    cut = cut.withColumn("shard", F.when(F.col("twice") > 0, share).otherwise(0))
    # At most one row for each shard.
    first = cut.groupBy("shard").agg(F.min("place").alias("first"))
    return cut.join(F.broadcast(first), "shard").select(
        "own.*", "shard", (F.col("place") - F.col("first")).alias("slot")
    )


def write_shards(documents: DataFrame, assigned: DataFrame, keys: list[str], path: str) -> None:
    """Writes the documents as Parquet, a folder for each shard, rows in slot order within a file."""
    both = documents.join(assigned.select(*keys, "shard", "slot"), keys)
    both.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
