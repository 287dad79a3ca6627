"""The account table in parts by id, of which a deactivation replaces only those that it changes."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dormouse.plans.deactivation import DEACTIVATED, accounts_after
from dormouse.sources.generations import Manifest, data_folder, publish, published

# Folders of the store; an account table may not have columns of these names.
GENERATION, PART = "store_generation", "store_part"
PARTS = 256


def _part(account_id: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(account_id.cast("bigint")), F.lit(parts)).cast("int")


def store_accounts(accounts: DataFrame, root: str, parts: int = PARTS) -> Manifest:
    """Writes the account table with all its columns as the first generation of a store.

    Accounts are dealt into parts by a hash of their id, so parts are about equal in size. Choose as
    many as make files of some hundred megabytes; what changes is rewritten a part at a time.
    """
    names = {name.lower(): name for name in accounts.columns}
    if "id" not in names:
        raise ValueError(f"an account table has an id; this has {sorted(names)}")
    taken = {GENERATION, PART} & set(names)
    if taken:
        raise ValueError(f"an account table cannot be stored with columns {sorted(taken)}")
    if published(accounts.sparkSession, root) is not None:
        raise ValueError(f"{root} holds a store already")
    manifest = Manifest(1, {str(part): 1 for part in range(parts)}, accounts.schema.json())
    _write(accounts.withColumn(PART, _part(F.col(names["id"]), parts)), root, 1)
    publish(accounts.sparkSession, root, manifest)
    return manifest


def stored_accounts(spark: SparkSession, root: str) -> DataFrame:
    """The account table of a store, as of its newest published generation."""
    manifest = _manifest(spark, root)
    return _read(spark, root, manifest, manifest.places).drop(GENERATION, PART)


def switch_off(spark: SparkSession, root: str, plan: DataFrame) -> list[int]:
    """Switches the accounts off that the plan deactivates, and gives the parts that were replaced.

    Only parts with such an account are read and written, as files of the next generation. These
    count once its manifest is written, last of all. A run that ended before left files that none
    counts; the next one replaces them where they are in its way.
    """
    manifest = _manifest(spark, root)
    parts = len(manifest.places)
    off = plan.filter(F.col("status") == DEACTIVATED).select(F.col("account_id").cast("bigint").alias("account_id"), "status")
    # At most one number for each part.
    touched = sorted(row[0] for row in off.select(_part(F.col("account_id"), parts)).distinct().collect())
    if not touched:
        return []
    number = manifest.generation + 1
    old = _read(spark, root, manifest, {str(part): manifest.places[str(part)] for part in touched})
    after = accounts_after(old.drop(GENERATION, PART), off)
    key = next(name for name in after.columns if name.lower() == "id")
    _write(after.withColumn(PART, _part(F.col(key), parts)), root, number)
    places = {**manifest.places, **{str(part): number for part in touched}}
    publish(spark, root, Manifest(number, places, manifest.schema))
    return touched


def _manifest(spark: SparkSession, root: str) -> Manifest:
    manifest = published(spark, root)
    if manifest is None:
        raise ValueError(f"{root} holds no account store")
    return manifest


def _write(accounts: DataFrame, root: str, generation: int) -> None:
    # Rows of a part come together, so that it has few files; a run again replaces what one before left.
    dealt = accounts.hint("rebalance", PART).withColumn(GENERATION, F.lit(generation))
    dealt.write.partitionBy(GENERATION, PART).mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(data_folder(root))


def _read(spark: SparkSession, root: str, manifest: Manifest, places: dict[str, int]) -> DataFrame:
    """The parts at their generations; other folders are not listed among the files to read."""
    schema = T.StructType.fromJson(json.loads(manifest.schema))
    schema = schema.add(GENERATION, T.LongType()).add(PART, T.IntegerType())
    by_generation: dict[int, list[int]] = {}
    for part, generation in places.items():
        by_generation.setdefault(generation, []).append(int(part))
    wanted = F.lit(False)
    for generation, parts in sorted(by_generation.items()):
        wanted = wanted | ((F.col(GENERATION) == generation) & F.col(PART).isin(*parts))
    return spark.read.schema(schema).parquet(data_folder(root)).filter(wanted)
