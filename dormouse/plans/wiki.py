"""Dormant accounts of the wiki."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dormouse.defaults import EXEMPT_GROUP, WIKI_MONTHS
from dormouse.functions.text import mention
from dormouse.functions.time import day_text, months_before, stale_or_never
from dormouse.operators import activity, identity
from dormouse.session import require_utc


def wiki_global_groups(space_permissions: DataFrame) -> DataFrame:
    """Groups with a permission that is not bound to one space."""
    return (
        space_permissions.filter(F.col("spaceid").isNull()).select("permgroupname").distinct()
    )


def wiki_users(accounts: DataFrame, directories: DataFrame) -> DataFrame:
    """Active accounts with the name of their directory, active or not."""
    names = directories.select(F.col("id").alias("directory_id"), "directory_name")
    return identity.active_accounts(accounts).join(names, "directory_id")


def wiki_dormant(
    tables: Mapping[str, DataFrame],
    as_of: datetime | str | Column | None = None,
    months: int = WIKI_MONTHS,
    exempt_group: str = EXEMPT_GROUP,
    strict: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """Wiki users with an old account, no login since the cutoff and no page edit since.

    By default a missing page edit counts as dormant only where the last login
    is missing too, and a missing last login makes any edit irrelevant.
    ``strict`` judges the page edit by itself. Users are cut down by all that does
    not need their logins before they are multiplied by the days of these.
    """
    require_utc(tables["account"])
    cut = months_before(as_of, months)
    users = wiki_users(tables["account"], tables["directory"])
    exempt = identity.exempt_accounts(
        tables["account"], tables["membership"], tables["grp"], exempt_group
    )
    edits = activity.wiki_last_edit(tables["content"], tables["user_mapping"], users)

    edited = F.col("lastpagemoddate")
    quiet = stale_or_never(edited, cut) if strict else (edited < cut) | F.col("lastlogin").isNull()

    people = users.filter(F.col("created_date") < cut).join(
        _members_of_global_groups(tables), "id", "left_semi"
    )
    people = identity.not_exempt(people, exempt).join(edits, "user_name", "left")
    if strict:
        people = people.filter(quiet)
    people = people.join(_stale_logins(tables, cut), "lower_user_name")
    if not strict:
        people = people.filter(quiet)
    result = (
        people.select(
            "user_name",
            "email_address",
            day_text(F.col("created_date")).alias("user_created"),
            "lastlogin",
            day_text(edited).alias("lastpagemoddate"),
            "directory_name",
        )
        .distinct()
        .select(mention(F.col("user_name")).alias("mention"), "email_address", "user_created",
                "lastlogin", "lastpagemoddate", "directory_name")
    )
    if not ordered:
        return result
    return result.orderBy(F.desc_nulls_last("lastlogin"), "mention", "directory_name")


def _members_of_global_groups(tables: Mapping[str, DataFrame]) -> DataFrame:
    permitted = tables["spaceperm"].filter(F.col("spaceid").isNull()).select(
        F.col("permgroupname").alias("lower_group_name")
    )
    groups = (
        tables["grp"]
        .join(permitted, "lower_group_name", "left_semi")
        .select(F.col("id").alias("parent_id"))
    )
    return (
        tables["membership"]
        .join(groups, "parent_id", "left_semi")
        .select(F.col("child_id").alias("id"))
        .distinct()
    )


def _stale_logins(tables: Mapping[str, DataFrame], cut: Column) -> DataFrame:
    """Days of the stale logins per lower-case name, NULL for a login without a date.

    Only the day reaches the result, so a key with very many logins is reduced
    to its days before it is joined.
    """
    days = (
        tables["logininfo"]
        .filter(stale_or_never(F.col("successdate"), cut))
        .select(F.col("username").alias("user_key"), day_text(F.col("successdate")).alias("lastlogin"))
        .distinct()
    )
    names = tables["user_mapping"].withColumnRenamed("lower_username", "lower_user_name")
    return days.join(names, "user_key").select("lower_user_name", "lastlogin")
