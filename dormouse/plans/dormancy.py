"""Dormant accounts of the tracker, and the accounts that consume a licence."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dormouse.defaults import EXEMPT_GROUP, LICENCE_ROLE, TRACKER_MONTHS, WRITABLE_DIRECTORY
from dormouse.functions.time import day_text, months_before, stale_or_never
from dormouse.operators import activity, identity
from dormouse.session import require_utc

_DAYS = ("lastlogin", "lastauth", "lastassign", "lastwatch", "lastreactivate")


def canonical_eligible(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The account each person with access authenticates against."""
    eligible = identity.eligible_accounts(
        tables["account"], tables["directory"], tables["membership"], tables["globalperm"]
    )
    return identity.canonical_account(eligible)


def dormant_accounts(
    tables: Mapping[str, DataFrame],
    as_of: datetime | str | Column | None = None,
    months: int = TRACKER_MONTHS,
    exempt_group: str = EXEMPT_GROUP,
    lenient: bool = False,
    ordered: bool = True,
    recent: DataFrame | None = None,
) -> DataFrame:
    """People with access, an account older than ``months`` and no activity since.

    Being watched as a user is reported but is no sign of life: others may do it.
    The account is chosen first, then judged; see ``canonical_account``. The
    joins on ``user_name`` come first because both sides are already
    partitioned by it, and the one on the account id last, on the rows left.

    Each side has one row per name, so the rows are distinct as they stand.
    ``ordered=False`` leaves out the global sort, for callers that go on.
    ``recent`` is the activity by name where that is at hand, as from a stored
    state; it is reduced from the event tables otherwise.
    """
    require_utc(tables["account"])
    cut = months_before(as_of, months)
    recent = activity.activity_by_name(tables) if recent is None else recent
    exempt = identity.exempt_accounts(
        tables["account"], tables["membership"], tables["grp"], exempt_group
    )
    people = canonical_eligible(tables).filter(F.col("created_date") < cut)
    people = (
        identity.not_exempt(people, exempt)
        .join(recent, "user_name", "left")
        .filter(
            stale_or_never(F.col("lastassign"), cut) & stale_or_never(F.col("lastreactivate"), cut)
        )
    )
    dormant = activity.account_activity(people, tables["attrs"], lenient).filter(
        stale_or_never(F.col("lastlogin"), cut) & stale_or_never(F.col("lastauth"), cut)
    )
    result = dormant.select(*listed_columns())
    return _by_last_login(result, "user_name") if ordered else result


def listed_columns() -> list[str | Column]:
    """What a list of dormant accounts shows of a person with all activity."""
    return [
        "user_name",
        "directory_id",
        "email_address",
        day_text(F.col("created_date")).alias("created"),
        *[day_text(F.col(name)).alias(name) for name in _DAYS],
        F.coalesce("assigneecount", F.lit(0)).alias("assigneecount"),
    ]


def dormant_external(
    dormant: DataFrame, email_suffix: str, directory_id: int = WRITABLE_DIRECTORY
) -> DataFrame:
    """The dormant accounts that may be switched off: one directory, outside addresses.

    An account without an address is left out.
    """
    return dormant.filter(
        ~F.col("email_address").endswith(email_suffix) & (F.col("directory_id") == directory_id)
    ).drop("directory_id", "assigneecount")


def licensed_accounts(tables: Mapping[str, DataFrame], role: str = LICENCE_ROLE) -> DataFrame:
    """Active accounts whose name is in a group of the licence role, in any directory."""
    groups = tables["license"].filter(F.col("license_role_name") == role)
    members = (
        tables["membership"]
        .join(groups.select(F.col("group_id").alias("lower_parent_name")),
              "lower_parent_name", "left_semi")
        .select(F.col("lower_child_name").alias("lower_user_name"))
        .distinct()
    )
    accounts = identity.in_active_directory(
        identity.active_accounts(tables["account"]), tables["directory"]
    )
    return (
        accounts.join(members, "lower_user_name", "left_semi")
        .groupBy("user_name", "email_address", "display_name")
        .agg(F.max("created_date").alias("created_date"))
    )


def _by_last_login(result: DataFrame, *then: str) -> DataFrame:
    return result.orderBy(F.desc_nulls_last("lastlogin"), *then)
