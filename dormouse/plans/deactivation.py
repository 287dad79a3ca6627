"""From dormant names to an action per account, a summary and a new account table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dormouse.defaults import WRITABLE_DIRECTORY
from dormouse.functions.text import row_text
from dormouse.operators import identity

NOT_FOUND = "not_found"
ALREADY_INACTIVE = "already_inactive"
VALIDATION_FAILED = "validation_failed"
DEACTIVATED = "deactivated"


def deactivation_plan(
    names: DataFrame,
    accounts: DataFrame,
    directories: DataFrame,
    writable_directories: Sequence[int] = (WRITABLE_DIRECTORY,),
    checks: Mapping[str, Column] | None = None,
) -> DataFrame:
    """What happens to each name: the account it resolves to, a status and a log text.

    ``names`` has a ``user_name`` and may have more columns, which the text of
    a deactivated account shows. A name, in any case, resolves to its account in
    the first active directory, active or not. Only accounts of the names asked
    for are looked through. ``checks`` maps an error text to a
    condition on the resolved account under which it applies; all errors of an
    account are listed.
    """
    looked_up = F.lower("user_name").alias("lower_user_name")
    # A comparison that every name passes: for a side with one, Spark tests large tables against a Bloom
    # filter of its keys while it scans them, so that only accounts asked for are shuffled.
    asked_names = names.filter(F.col("user_name") >= "").select(looked_up)
    asked = accounts.join(asked_names, "lower_user_name", "left_semi")
    resolved = identity.canonical_account(
        identity.in_active_directory(asked, directories), "lower_user_name"
    )
    errors = {"directory is read-only": ~F.col("directory_id").isin(*writable_directories)}
    errors.update(checks or {})
    failures = F.concat_ws(",", *[F.when(failed, F.lit(text)) for text, failed in errors.items()])
    row = row_text([name for name in names.columns if name != "user_name"])

    resolved = resolved.select(
        "lower_user_name",
        F.col("id").alias("account_id"),
        "directory_id",
        "is_active",
        failures.alias("failures"),
    )
    rows = names.select("user_name", looked_up, row.alias("row"))
    status = (
        F.when(F.col("account_id").isNull(), F.lit(NOT_FOUND))
        .when(~F.coalesce("is_active", F.lit(False)), F.lit(ALREADY_INACTIVE))
        .when(F.col("failures") != "", F.lit(VALIDATION_FAILED))
        .otherwise(F.lit(DEACTIVATED))
    )
    return (
        rows.join(resolved, "lower_user_name", "left")
        .withColumn("status", status)
        .select("user_name", "account_id", "directory_id", "status", _detail().alias("detail"))
    )


def _detail() -> Column:
    status = F.col("status")
    error = (
        F.when(status == NOT_FOUND, F.lit("Not found"))
        .when(status == ALREADY_INACTIVE, F.lit("Already inactive"))
        .otherwise(F.col("failures"))
    )
    done = F.format_string("Deactivated %s", "user_name")
    failed = F.format_string("Failed to deactivate %s", "user_name")
    return F.when(
        status == DEACTIVATED, F.concat_ws(": ", done, F.nullif("row", F.lit("")))
    ).otherwise(F.concat_ws(": ", failed, error))


def deactivation_summary(plan: DataFrame) -> DataFrame:
    """Number of names per status, with the closing line for the deactivated ones."""
    return (
        plan.groupBy("status")
        .agg(F.count("*").alias("users"))
        .withColumn("message", F.when(F.col("status") == DEACTIVATED, _closing_line()))
    )


def _closing_line() -> Column:
    return F.format_string("%d inactive users automatically deactivated.", F.col("users"))


def observed(plan: DataFrame) -> tuple[DataFrame, Observation]:
    """The plan, and an observation that has counted its statuses once the plan was written."""
    statuses = (NOT_FOUND, ALREADY_INACTIVE, VALIDATION_FAILED, DEACTIVATED)
    observation = Observation("statuses")
    counts = [F.count_if(F.col("status") == status).alias(status) for status in statuses]
    return plan.observe(observation, *counts), observation


def observed_summary(spark: SparkSession, observation: Observation) -> DataFrame:
    """Equal to ``deactivation_summary`` of the observed plan, without another pass over it."""
    counts = [(status, users) for status, users in observation.get.items() if users]
    rows = spark.createDataFrame(counts, "status string, users long")
    return rows.withColumn("message", F.when(F.col("status") == DEACTIVATED, _closing_line()))


def accounts_after(accounts: DataFrame, plan: DataFrame) -> DataFrame:
    """The account table with the deactivated accounts switched off, all else unchanged.

    ``accounts`` is the table as its source has it: every column stays, in its
    order and type, and ``active`` keeps its coding (a number, ``T`` and ``F``, or
    a boolean). ``is_active`` of an opened table will do as well.
    """
    named = {field.name.lower(): field for field in accounts.schema}
    flag = named.get("active") or named.get("is_active")
    if flag is None or "id" not in named:
        raise ValueError(f"an account table has an id and a flag active; this has {sorted(named)}")
    if isinstance(flag.dataType, T.BooleanType):
        off = F.lit(False)
    elif isinstance(flag.dataType, T.StringType):
        off = F.lit("F")
    else:
        off = F.lit(0).cast(flag.dataType)
    key = "_switched_off"
    while key in named:
        key += "_"
    switched_off = (
        plan.filter(F.col("status") == DEACTIVATED)
        .select(F.col("account_id").cast("bigint").alias(key))
        .distinct()
    )
    own_id = _named(accounts, named["id"].name).cast("bigint")
    joined = accounts.join(switched_off, own_id == F.col(key), "left")
    state = F.when(F.col(key).isNotNull(), off).otherwise(_named(accounts, flag.name))
    return joined.select(
        *[
            state.alias(name) if name == flag.name else _named(accounts, name)
            for name in accounts.columns
        ]
    )


def _named(table: DataFrame, name: str) -> Column:
    return table["`" + name.replace("`", "``") + "`"]
