"""When people were last active, one row per person and kind of activity.

Event tables are the large inputs. Each is filtered and cut to the columns
used. Watches, audit rows, page edits and issues are reduced to one row per key
before they are shuffled, and only then joined to the account tables; a change
is an event only together with its change group, so those two are joined first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dormouse.defaults import (
    ASSIGNEE_FIELD,
    AUDIT_ACCOUNT_TYPE,
    LAST_AUTH_ATTRIBUTE,
    LAST_LOGIN_ATTRIBUTE,
    REACTIVATION_SUFFIX,
    WATCH_ASSOCIATION,
)
from dormouse.functions.time import millis_text_to_timestamp, millis_to_date

_LOGIN_COLUMNS = {"lastlogin": LAST_LOGIN_ATTRIBUTE, "lastauth": LAST_AUTH_ATTRIBUTE}


def login_stats(attributes: DataFrame) -> DataFrame:
    """Last login and authentication per account, from one pass over the attributes.

    The ``*_rejects`` columns count values that are present but no times.
    """
    value = F.col("attribute_value")
    moment = millis_text_to_timestamp(value)
    rejected = value.isNotNull() & moment.isNull()
    measures = []
    for column, attribute in _LOGIN_COLUMNS.items():
        named = F.col("attribute_name") == attribute
        measures.append(F.max(F.when(named, moment)).alias(column))
        measures.append(F.count_if(named & rejected).alias(f"{column}_rejects"))
    return (
        attributes.filter(F.col("attribute_name").isin(*_LOGIN_COLUMNS.values()))
        .groupBy("user_id", "directory_id")
        .agg(*measures)
    )


def account_activity(accounts: DataFrame, attributes: DataFrame, lenient: bool = False) -> DataFrame:
    """Accounts with ``lastlogin`` and ``lastauth``; NULL where nothing is recorded.

    A value that is not a number, or beyond the years 1 to 9999, ends the query, as
    the owner would otherwise look as if they had never logged in. ``lenient``
    reads it as absent; ``attribute_rejects`` counts such values.
    """
    stats = login_stats(attributes).withColumnRenamed("user_id", "id")
    columns = [
        F.col(column) if lenient else _checked(column).alias(column) for column in _LOGIN_COLUMNS
    ]
    return accounts.join(stats, ["id", "directory_id"], "left").select(*accounts.columns, *columns)


def _checked(column: str) -> Column:
    message = F.format_string(f"{column} of account %d is not a time", F.col("id"))
    return F.when(F.col(f"{column}_rejects") > 0, F.raise_error(message)).otherwise(F.col(column))


def attribute_rejects(attributes: DataFrame) -> DataFrame:
    """How many values ``lenient`` reading of the attributes passes over."""
    return login_stats(attributes).agg(
        *[
            F.coalesce(F.sum(f"{column}_rejects"), F.lit(0)).alias(f"{column}_rejects")
            for column in _LOGIN_COLUMNS
        ]
    )


def assignments(change_groups: DataFrame, change_items: DataFrame) -> DataFrame:
    """Every time a user was made the assignee of an issue."""
    assigned = change_items.filter(F.col("field") == ASSIGNEE_FIELD).select(
        "groupid", F.col("newvalue").alias("user_name")
    )
    moments = change_groups.select(F.col("id").alias("groupid"), F.col("created").alias("lastassign"))
    return assigned.join(moments, "groupid").select("user_name", "lastassign")


def watches(associations: DataFrame, key_map: DataFrame, accounts: DataFrame) -> DataFrame:
    """Last time an issue was put on a watch list, by whomever, per account of its owner."""
    watched = associations.filter(F.col("association_type") == WATCH_ASSOCIATION)
    latest = latest_by_key(watched, "source_name", F.max("created"), key_map)
    return latest_of_accounts(latest, accounts).withColumnRenamed("latest", "lastwatch")


def reactivations(audit: DataFrame, key_map: DataFrame) -> DataFrame:
    """Day on which an account was last switched on again, per user key.

    ``user_name`` holds the lower-case name, which is what the result is joined by.
    """
    switched_on = audit.filter(
        (F.col("primary_resource_type") == AUDIT_ACCOUNT_TYPE)
        & F.col("change_values").endswith(REACTIVATION_SUFFIX)
    )
    latest = latest_by_key(
        switched_on, "primary_resource_id", F.max("entity_timestamp"), key_map
    )
    return latest.select(
        F.col("lower_user_name").alias("user_name"),
        millis_to_date(F.col("latest")).alias("lastreactivate"),
    )


def last_assignment(change_groups: DataFrame, change_items: DataFrame) -> DataFrame:
    """Last time each user was made the assignee of an issue."""
    return _latest_by_name(assignments(change_groups, change_items), "lastassign")


def last_watch(associations: DataFrame, key_map: DataFrame, accounts: DataFrame) -> DataFrame:
    """Last time an issue was put on each user's watch list, by whomever."""
    return _latest_by_name(watches(associations, key_map, accounts), "lastwatch")


def last_reactivation(audit: DataFrame, key_map: DataFrame) -> DataFrame:
    """Day on which each account was last switched on again."""
    return _latest_by_name(reactivations(audit, key_map), "lastreactivate")


def wiki_last_edit(content: DataFrame, key_map: DataFrame, accounts: DataFrame) -> DataFrame:
    """Last page edit of each user among the given accounts."""
    names = key_map.withColumnRenamed("lower_username", "lower_user_name")
    latest = latest_by_key(content, "lastmodifier", F.max("lastmoddate"), names)
    edits = latest_of_accounts(latest, accounts).withColumnRenamed("latest", "lastpagemoddate")
    return _latest_by_name(edits, "lastpagemoddate")


def assignee_count(issues: DataFrame) -> DataFrame:
    """Number of issues assigned to each user who has any."""
    return (
        issues.filter(F.col("assignee").isNotNull())
        .groupBy(F.col("assignee").alias("user_name"))
        .agg(F.count("*").alias("assigneecount"))
    )


def activity_by_name(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Last assignment, reactivation and watch, and the number of issues, per user name.

    The four kinds are put under each other and reduced together, so that they
    share one shuffle by name and are joined to the people as one table.
    """
    return together_by_name([
        assignments(tables["changegroup"], tables["changeitem"]),
        reactivations(tables["audit"], tables["app_user"]),
        watches(tables["userassociation"], tables["app_user"], tables["account"]),
        issue_rows(tables["issue"]),
    ])


def issue_rows(issues: DataFrame) -> DataFrame:
    """A one for every issue of an assignee, to be summed up by name."""
    return issues.select(F.col("assignee").alias("user_name"), F.lit(1).cast("bigint").alias("assigneecount"))


def together_by_name(kinds: Sequence[DataFrame]) -> DataFrame:
    """Rows of the four kinds, each with its own column, reduced to one row per name."""
    together = reduce(lambda one, two: one.unionByName(two, allowMissingColumns=True), kinds)
    return together.groupBy("user_name").agg(
        F.max("lastassign").alias("lastassign"),
        F.max("lastreactivate").alias("lastreactivate"),
        F.max("lastwatch").alias("lastwatch"),
        F.sum("assigneecount").alias("assigneecount"),
    )


def latest_by_key(events: DataFrame, key: str, latest: Column, key_map: DataFrame) -> DataFrame:
    """Latest event and lower-case name per user key; the map is joined per key, not per event."""
    per_key = events.groupBy(F.col(key).alias("user_key")).agg(latest.alias("latest"))
    return per_key.join(key_map, "user_key").select("lower_user_name", "latest")


def latest_of_accounts(latest: DataFrame, accounts: DataFrame) -> DataFrame:
    """The latest event of a lower-case name, for each account that has the name."""
    per_name = latest.groupBy("lower_user_name").agg(F.max("latest").alias("latest"))
    return (
        accounts.select("user_name", "lower_user_name")
        .join(per_name, "lower_user_name")
        .select("user_name", "latest")
    )


def _latest_by_name(events: DataFrame, column: str) -> DataFrame:
    return events.groupBy("user_name").agg(F.max(column).alias(column))
