"""Which accounts count, and which one stands for a person."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dormouse.defaults import ACCESS_PERMISSIONS, EXEMPT_GROUP


def active_accounts(accounts: DataFrame) -> DataFrame:
    return accounts.filter("is_active")


def active_account_count(accounts: DataFrame) -> DataFrame:
    return active_accounts(accounts).agg(F.count("*").alias("active_accounts"))


def in_active_directory(accounts: DataFrame, directories: DataFrame) -> DataFrame:
    """Accounts of active directories, with the position of their directory."""
    open_directories = directories.filter("is_active").select(
        F.col("id").alias("directory_id"), "directory_position"
    )
    return accounts.join(open_directories, "directory_id")


def access_members(
    memberships: DataFrame,
    permissions: DataFrame,
    granting: Sequence[str] = ACCESS_PERMISSIONS,
) -> DataFrame:
    """Names, per directory, that a permitted group lets in.

    Only existence matters, so a name in many groups is reduced to one row
    before the shuffle, on the key that the account side is joined by.
    """
    groups = permissions.filter(F.col("permission").isin(*granting)).select(
        F.col("group_id").alias("lower_parent_name")
    )
    return (
        memberships.join(groups, "lower_parent_name", "left_semi")
        .select(F.col("lower_child_name").alias("lower_user_name"), "directory_id")
        .distinct()
    )


def eligible_accounts(
    accounts: DataFrame, directories: DataFrame, memberships: DataFrame, permissions: DataFrame
) -> DataFrame:
    """Active accounts of active directories that have access in their own directory."""
    members = access_members(memberships, permissions)
    return in_active_directory(active_accounts(accounts), directories).join(
        members, ["lower_user_name", "directory_id"], "left_semi"
    )


def canonical_account(accounts: DataFrame, name: str = "user_name") -> DataFrame:
    """One account per name: the one in the first directory by position.

    ``name`` is ``lower_user_name`` where people are looked up by name, which
    directories do without regard to case.

    Each task keeps only its best row per name before the shuffle, so a name
    with very many rows does not load the task that picks the winner. Filters
    on the account must be applied before this step if an account that fails
    them may be replaced by the next one, and after it if not.
    """
    first = Window.partitionBy(name).orderBy("directory_position", "directory_id", "id")
    return (
        accounts.withColumn("place", F.row_number().over(first))
        .filter(F.col("place") == 1)
        .drop("place")
    )


def exempt_accounts(
    accounts: DataFrame, memberships: DataFrame, groups: DataFrame, exempt_group: str = EXEMPT_GROUP
) -> DataFrame:
    """User names of the accounts in the exempt group, one row per membership."""
    exempt = groups.filter(F.col("group_name") == exempt_group).select(
        F.col("id").alias("parent_id")
    )
    members = memberships.join(exempt, "parent_id").select(F.col("child_id").alias("id"))
    return accounts.select("id", "user_name").join(members, "id").select("user_name")


def not_exempt(accounts: DataFrame, exempt: DataFrame) -> DataFrame:
    """Accounts whose user name is not in the exempt list; a NULL name matches nothing."""
    return accounts.join(exempt.select("user_name").distinct(), "user_name", "left_anti")
