"""Session settings the queries are written for."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Days and calendar months are those of UTC.
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution merges small shuffle partitions, turns a shuffle join
    # into a broadcast one where the measured side is small, and splits skewed
    # partitions of a join, also where that costs another shuffle.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Scans from this size on are tested against a Bloom filter of a small other side of their join.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1g",
}

# Shuffle data one task should get; more spills, less drowns in task overhead.
SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024

# File data one task reads: the default, raised for tables that would otherwise
# be cut into more tasks than a driver handles well, within what a task can take.
SCAN_PARTITION_BYTES = 128 * 1024 * 1024
MAX_SCAN_PARTITION_BYTES = 1024 * 1024 * 1024
MAX_SCAN_TASKS = 100_000


# Planned sizes from here on stand for sources of unknown size.
UNKNOWN_BYTES = 1 << 60

# Names of the zone that days and months are meant in.
UTC_ZONES = {
    "utc", "etc/utc", "gmt", "etc/gmt", "z", "+00:00", "utc+00:00", "gmt+00:00",
    "universal", "etc/universal", "zulu", "etc/zulu",
}


def require_utc(table: DataFrame) -> None:
    """Refuses a session in another zone, where days and cutoffs would silently be others."""
    zone = table.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone.lower() not in UTC_ZONES:
        raise ValueError(f"the session's time zone is {zone}; apply_settings sets UTC")


def planned_bytes(tables: Iterable[DataFrame]) -> int:
    """The size of the largest table as the planner expects it, columns used only.

    A source that tells no size counts as nothing; Spark plans with an absurd one.
    """
    sizes = (
        int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        for table in tables
    )
    return max((size for size in sizes if size < UNKNOWN_BYTES), default=0)


def apply_settings(
    spark: SparkSession, shuffle_bytes: int | None = None, input_bytes: int | None = None
) -> SparkSession:
    """Put the settings on a running session.

    ``shuffle_bytes`` is the size of the largest shuffle expected, which is
    at most about that of the used columns of the largest table, as
    ``planned_bytes`` tells. The number of shuffle partitions follows from it but
    is never set below what the session has, and adaptive execution merges what
    turns out smaller. ``input_bytes`` is the size of the largest table
    and sets how much of it one task reads.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if shuffle_bytes is not None:
        partitions = max(
            int(spark.conf.get("spark.sql.shuffle.partitions")),
            -(-shuffle_bytes // SHUFFLE_PARTITION_BYTES),
        )
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    if input_bytes is not None:
        split = max(SCAN_PARTITION_BYTES, -(-input_bytes // MAX_SCAN_TASKS))
        split = min(split, MAX_SCAN_PARTITION_BYTES)
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    return spark
