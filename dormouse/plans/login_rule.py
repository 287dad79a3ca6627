"""The simpler rule: last login, else creation date, longer ago than a number of years."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dormouse.defaults import LAST_LOGIN_ATTRIBUTE, LOGIN_RULE_YEARS, WRITABLE_DIRECTORY
from dormouse.functions.time import instant, millis_to_timestamp, years_after
from dormouse.operators import identity
from dormouse.session import require_utc

LOGIN, NEVER_LOGGED_IN, UNPARSEABLE = "login", "never_logged_in", "unparseable"
UNRESOLVED = "unresolved"


def login_rule_verdicts(
    tables: Mapping[str, DataFrame],
    as_of: datetime | str | Column | None = None,
    years: int = LOGIN_RULE_YEARS,
    directory_id: int = WRITABLE_DIRECTORY,
) -> DataFrame:
    """Every active account of one directory, with when it expires and why.

    The creation date is that of the checked account; the login value is that
    of the account its name, in any case, resolves to. A name that resolves to
    none gives the reason ``unresolved``, and a value that is neither a time nor
    empty ``unparseable``; neither is dormant. An account without a creation
    date counts as used now.
    """
    require_utc(tables["account"])
    now = instant(as_of)
    checked = identity.active_accounts(tables["account"]).filter(
        F.col("directory_id") == directory_id
    )
    resolved = identity.canonical_account(
        identity.in_active_directory(tables["account"], tables["directory"]), "lower_user_name"
    ).select(
        "lower_user_name", F.col("id").alias("user_id"), F.col("directory_id").alias("home_id")
    )
    reason = (
        F.when(F.col("user_id").isNull(), F.lit(UNRESOLVED))
        .when(F.col("last_login_number").isNotNull(), F.lit(LOGIN))
        .when(F.coalesce("last_login_text", F.lit("")) == "", F.lit(NEVER_LOGGED_IN))
        .otherwise(F.lit(UNPARSEABLE))
    )
    last_used = F.when(
        F.col("reason") == LOGIN, millis_to_timestamp(F.col("last_login_number"))
    ).when(F.col("reason") == NEVER_LOGGED_IN, F.coalesce("created_date", now))
    shown = F.coalesce(F.col("last_login_number").cast("string"), "last_login_text")
    return (
        checked.select("user_name", "lower_user_name", "created_date")
        .join(resolved, "lower_user_name", "left")
        .join(_login_values(tables["attrs"]), ["user_id", "home_id"], "left")
        .withColumn("last_login_millis", shown)
        .withColumn("reason", reason)
        .withColumn("last_used", last_used)
        .withColumn("expires_at", years_after(F.col("last_used"), years))
        .withColumn("is_dormant", F.coalesce(F.col("expires_at") < now, F.lit(False)))
        .select("user_name", "created_date", "last_login_millis", "last_used", "reason",
                "expires_at", "is_dormant")
    )


def dormant_by_login_rule(
    tables: Mapping[str, DataFrame],
    as_of: datetime | str | Column | None = None,
    years: int = LOGIN_RULE_YEARS,
    directory_id: int = WRITABLE_DIRECTORY,
) -> DataFrame:
    """The accounts that the login rule finds dormant."""
    verdicts = login_rule_verdicts(tables, as_of, years, directory_id)
    return verdicts.filter("is_dormant").drop("expires_at", "is_dormant")


def login_rule_counts(verdicts: DataFrame) -> DataFrame:
    """Accounts checked and found dormant, by reason; skipped values included."""
    return verdicts.groupBy("reason").agg(
        F.count("*").alias("checked"), F.count_if("is_dormant").alias("dormant")
    )


def _login_values(attributes: DataFrame) -> DataFrame:
    """Per account the largest login that is a time and, where there is none, the last text by order.

    Both come from one choice of a row per account, so the attributes are read and shuffled once;
    each task keeps only its best row of an account before the shuffle.
    """
    value = F.col("attribute_value")
    number = value.try_cast("bigint")
    rows = attributes.filter(F.col("attribute_name") == LAST_LOGIN_ATTRIBUTE).select(
        "user_id",
        F.col("directory_id").alias("home_id"),
        F.when(millis_to_timestamp(number).isNotNull(), number).alias("last_login_number"),
        value.alias("last_login_text"),
    )
    best = Window.partitionBy("user_id", "home_id").orderBy(
        F.desc_nulls_last("last_login_number"), F.desc_nulls_last("last_login_text")
    )
    return rows.withColumn("place", F.row_number().over(best)).filter("place = 1").drop("place")
