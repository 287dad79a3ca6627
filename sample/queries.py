"""One query per operator over the sample data, as ``(spark, sf_dir) -> DataFrame``.

Timestamps are returned as text, so that a comparison does not depend on how
an engine represents them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dormouse.operators import activity, activity_state, identity, quarantine
from dormouse.plans import deactivation, dormancy, expiry, login_rule, wiki
from dormouse.session import apply_settings
from dormouse.sources.schemas import TRACKER, WIKI
from dormouse.sources.tables import Tables
from sample.tables import AS_OF, FIRST_AUDIT, FIRST_WATCH, INTERNAL_SUFFIX, SINCE, sample_tables

Query = Callable[[SparkSession, str], DataFrame]
TableQuery = Callable[[Tables], DataFrame]


def _over(schemas: Mapping[str, T.StructType], query: TableQuery) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _prepare(spark)
        return _times_as_text(query(sample_tables(spark, sf_dir, schemas)))

    return run


@cache
def _prepare(spark: SparkSession) -> None:
    """Puts the library's settings on a session when its first query is built."""
    apply_settings(spark)


def _times_as_text(result: DataFrame) -> DataFrame:
    columns = []
    for field in result.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        columns.append(column.alias(field.name))
    return result.select(*columns)


def _exempt(t: Mapping[str, DataFrame]) -> DataFrame:
    return identity.exempt_accounts(t["account"], t["membership"], t["grp"])


def _not_exempt(t: Mapping[str, DataFrame]) -> DataFrame:
    kept = identity.not_exempt(dormancy.canonical_eligible(t), _exempt(t))
    return kept.select("user_name", "directory_id", "id")


def _external(t: Mapping[str, DataFrame], ordered: bool = True) -> DataFrame:
    return dormancy.dormant_external(
        dormancy.dormant_accounts(t, AS_OF, ordered=ordered), INTERNAL_SUFFIX
    )


def _plan(t: Mapping[str, DataFrame]) -> DataFrame:
    names = _external(t, ordered=False)
    return deactivation.deactivation_plan(names, t["account"], t["directory"])


def _login_rule_plan(t: Mapping[str, DataFrame]) -> DataFrame:
    names = login_rule.dormant_by_login_rule(t, AS_OF)
    return deactivation.deactivation_plan(names, t["account"], t["directory"])


def _activity_from_state(t: Mapping[str, DataFrame]) -> DataFrame:
    """All activity by name from a state of the first events and two additions that overlap."""
    ends = activity_state.marks_of(t)
    cuts = [
        activity_state.Marks(
            ends.changegroup * part // 10,
            _between(FIRST_WATCH, ends.watch, part),
            _between(FIRST_AUDIT, ends.audit, part),
        )
        for part in (4, 6, 8)
    ]
    stretches = [(activity_state.Marks(), cuts[1]), (cuts[0], cuts[2]), (cuts[2], activity_state.Marks())]
    states = [activity_state.latest_between(t, since, until) for since, until in stretches]
    return activity_state.activity_by_name(activity_state.merged(*states), t)


def _between(first: int, last: int, tenths: int) -> int:
    return first + (last - first) * tenths // 10


def _newly_dormant(t: Mapping[str, DataFrame]) -> DataFrame:
    return expiry.newly_dormant(expiry.account_expiries(t), SINCE, AS_OF)


TRACKER_QUERIES: dict[str, TableQuery] = {
    "dormant_accounts": lambda t: dormancy.dormant_accounts(t, AS_OF),
    "dormant_external": _external,
    "licensed_accounts": dormancy.licensed_accounts,
    "dormant_by_login_rule": lambda t: login_rule.dormant_by_login_rule(t, AS_OF),
    "deactivation_plan": _plan,
    "deactivation_summary": lambda t: deactivation.deactivation_summary(_plan(t)),
    "accounts_after": lambda t: deactivation.accounts_after(t.raw("account"), _plan(t)),
    "login_rule_plan": _login_rule_plan,
    "login_rule_summary": lambda t: deactivation.deactivation_summary(_login_rule_plan(t)),
    "canonical_account": lambda t: dormancy.canonical_eligible(t).select(
        "user_name", "directory_id", "id", "email_address", "created_date"
    ),
    "access_members": lambda t: identity.access_members(t["membership"], t["globalperm"]),
    "exempt_accounts": _exempt,
    "not_exempt": _not_exempt,
    "active_account_count": lambda t: identity.active_account_count(t["account"]),
    "account_activity": lambda t: activity.account_activity(
        identity.active_accounts(t["account"]).select("id", "directory_id", "user_name"),
        t["attrs"],
    ),
    "last_assignment": lambda t: activity.last_assignment(t["changegroup"], t["changeitem"]),
    "last_watch": lambda t: activity.last_watch(t["userassociation"], t["app_user"], t["account"]),
    "last_reactivation": lambda t: activity.last_reactivation(t["audit"], t["app_user"]),
    "assignee_count": lambda t: activity.assignee_count(t["issue"]),
    "account_expiry": lambda t: expiry.account_expiries(t).select(
        "user_name", "last_active", "expires_at", "expires_on"
    ),
    "newly_dormant": _newly_dormant,
    "activity_from_state": _activity_from_state,
    "rejected_logins": lambda t: quarantine.rejected_values(t["attrs"]),
}

WIKI_QUERIES: dict[str, TableQuery] = {
    "wiki_dormant": lambda t: wiki.wiki_dormant(t, AS_OF),
    "wiki_dormant_strict": lambda t: wiki.wiki_dormant(t, AS_OF, strict=True),
    "wiki_global_groups": lambda t: wiki.wiki_global_groups(t["spaceperm"]),
    "wiki_last_edit": lambda t: activity.wiki_last_edit(
        t["content"], t["user_mapping"], wiki.wiki_users(t["account"], t["directory"])
    ),
}

QUERIES: dict[str, Query] = {
    **{name: _over(TRACKER, query) for name, query in TRACKER_QUERIES.items()},
    **{name: _over(WIKI, query) for name, query in WIKI_QUERIES.items()},
}
