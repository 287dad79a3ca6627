"""The tracker's views in a catalog database, for programs that read them by SQL: three for now, and two with parameters."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from dormouse import defaults
from dormouse.functions.time import FIRST_MILLIS, LAST_MILLIS
from dormouse.plans.views import ACTIVE_VIEW, DORMANT_VIEW, EXTERNAL_VIEW
from dormouse.sources.schemas import SOURCE_NAMES

_ACTIVE = """
SELECT user_name, email_address, display_name, max(created_date) AS created_date
FROM {account} a
LEFT SEMI JOIN (SELECT id FROM {directory} WHERE {directory_open}) d ON d.id = a.directory_id
LEFT SEMI JOIN (
    SELECT lower_child_name FROM {membership}
    WHERE lower_parent_name IN (SELECT group_id FROM {license} WHERE license_role_name = {role})
) m ON m.lower_child_name = a.lower_user_name
WHERE {account_open}
GROUP BY user_name, email_address, display_name
"""

_DORMANT = """
WITH since AS (SELECT {as_of} - make_ym_interval(0, {months}) AS cut),
member AS (
    SELECT DISTINCT lower_child_name, directory_id FROM {membership}
    WHERE lower_parent_name IN (SELECT group_id FROM {globalperm} WHERE permission IN ({granting}))
),
person AS (
    SELECT * FROM (
        SELECT a.id, a.user_name, a.directory_id, a.email_address, a.created_date,
               row_number() OVER (PARTITION BY a.user_name
                                  ORDER BY d.directory_position, d.id, a.id) AS place
        FROM {account} a JOIN {directory} d ON d.id = a.directory_id
        LEFT SEMI JOIN member m
            ON m.lower_child_name = a.lower_user_name AND m.directory_id = a.directory_id
        WHERE {account_open_a} AND {directory_open_d}
    ) WHERE place = 1
),
exempt AS (
    SELECT DISTINCT a.user_name FROM {account} a
    JOIN {membership} m ON m.child_id = a.id
    JOIN {grp} g ON g.id = m.parent_id
    WHERE g.group_name = {exempt}
),
value AS (
    SELECT user_id, directory_id, attribute_name, attribute_value,
           try_cast(attribute_value AS DECIMAL(38, 6)) AS number
    FROM {attrs} WHERE attribute_name IN ({login}, {auth})
),
moment AS (
    SELECT user_id, directory_id, attribute_name,
           CASE WHEN attribute_value IS NULL THEN NULL
                WHEN number BETWEEN {first} AND {last}
                THEN timestamp_micros(CAST(round(CAST(number AS DECIMAL(21, 6)) * 1000) AS BIGINT))
           END AS moment,
           attribute_value IS NOT NULL AND NOT ifnull(number BETWEEN {first} AND {last}, false) AS bad
    FROM value
),
login AS (
    SELECT user_id, directory_id, bool_or(bad) AS bad,
           max(moment) FILTER (WHERE attribute_name = {login}) AS lastlogin,
           max(moment) FILTER (WHERE attribute_name = {auth}) AS lastauth
    FROM moment GROUP BY user_id, directory_id
),
assignment AS (
    SELECT i.newvalue AS user_name, max(g.created) AS lastassign
    FROM {changeitem} i JOIN {changegroup} g ON g.id = i.groupid
    WHERE i.field = {assignee} GROUP BY i.newvalue
),
watch AS (
    SELECT a.user_name, max(w.latest) AS lastwatch
    FROM (SELECT source_name, max(created) AS latest FROM {userassociation}
          WHERE association_type = {watching} GROUP BY source_name) w
    JOIN {app_user} k ON k.user_key = w.source_name
    JOIN {account} a ON a.lower_user_name = k.lower_user_name
    GROUP BY a.user_name
),
reactivation AS (
    SELECT k.lower_user_name AS user_name,
           CAST(timestamp_seconds(max(r.latest) DIV 1000) AS DATE) AS lastreactivate
    FROM (SELECT primary_resource_id, max(entity_timestamp) AS latest FROM {audit}
          WHERE primary_resource_type = {audited} AND endswith(change_values, {reactivated})
          GROUP BY primary_resource_id) r
    JOIN {app_user} k ON k.user_key = r.primary_resource_id
    GROUP BY k.lower_user_name
),
issues AS (
    SELECT assignee AS user_name, count(*) AS assigneecount FROM {issue}
    WHERE assignee IS NOT NULL GROUP BY assignee
),
judged AS (
    SELECT p.*, s.lastassign, w.lastwatch, r.lastreactivate, n.assigneecount,
           if(l.bad, raise_error(concat('a login of account ', p.id, ' is not a time')), l.lastlogin)
               AS lastlogin,
           l.lastauth
    FROM (SELECT * FROM person WHERE created_date < (SELECT cut FROM since)) p
    LEFT ANTI JOIN exempt e ON e.user_name = p.user_name
    LEFT JOIN assignment s ON s.user_name = p.user_name
    LEFT JOIN reactivation r ON r.user_name = p.user_name
    LEFT JOIN watch w ON w.user_name = p.user_name
    LEFT JOIN issues n ON n.user_name = p.user_name
    LEFT JOIN login l ON l.user_id = p.id AND l.directory_id = p.directory_id
)
SELECT user_name, directory_id, email_address,
       date_format(created_date, 'yyyy-MM-dd') AS created,
       date_format(lastlogin, 'yyyy-MM-dd') AS lastlogin,
       date_format(lastauth, 'yyyy-MM-dd') AS lastauth,
       date_format(lastassign, 'yyyy-MM-dd') AS lastassign,
       date_format(lastwatch, 'yyyy-MM-dd') AS lastwatch,
       date_format(lastreactivate, 'yyyy-MM-dd') AS lastreactivate,
       ifnull(assigneecount, 0) AS assigneecount
FROM judged, since
WHERE ifnull(lastlogin < cut, true) AND ifnull(lastauth < cut, true)
  AND ifnull(lastassign < cut, true) AND ifnull(lastreactivate < cut, true)
"""

_EXTERNAL = """
SELECT * EXCEPT (directory_id, assigneecount) FROM {dormant}
WHERE directory_id = {writable} AND NOT endswith(email_address, {suffix})
"""


# Lists at any instant, for any period and exempt group; parameters are not named like any column.
DORMANT_FUNCTION, EXTERNAL_FUNCTION = f"{DORMANT_VIEW}_at", f"{EXTERNAL_VIEW}_at"
_DAYS = "created STRING, lastlogin STRING, lastauth STRING, lastassign STRING, lastwatch STRING, lastreactivate STRING"

_DORMANT_AT = (
    """
CREATE OR REPLACE FUNCTION {database}.{function}(
    as_of TIMESTAMP DEFAULT current_timestamp(), months INT DEFAULT {default_months},
    exempt_group STRING DEFAULT {default_exempt})
RETURNS TABLE (user_name STRING, directory_id BIGINT, email_address STRING, """
    + _DAYS
    + """, assigneecount BIGINT)
RETURN """
    + _DORMANT
)

_EXTERNAL_AT = (
    """
CREATE OR REPLACE FUNCTION {database}.{function}(
    outside_of STRING DEFAULT {suffix}, as_of TIMESTAMP DEFAULT current_timestamp(),
    months INT DEFAULT {default_months}, exempt_group STRING DEFAULT {default_exempt},
    writable_directory BIGINT DEFAULT {writable})
RETURNS TABLE (user_name STRING, email_address STRING, """
    + _DAYS
    + """)
RETURN SELECT * EXCEPT (directory_id, assigneecount) FROM ("""
    + _DORMANT
    + """) WHERE directory_id = writable_directory AND NOT endswith(email_address, outside_of)
"""
)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def store_views(
    spark: SparkSession,
    database: str,
    email_suffix: str,
    names: Mapping[str, str] = SOURCE_NAMES,
) -> None:
    """Create or replace the views and functions in the database that holds the source tables.

    They outlast the session. The three views are evaluated at the time of each read. The table
    functions ``inactive_users_all_at(as_of, months, exempt_group)`` and
    ``inactive_users_at(outside_of, as_of, months, exempt_group, writable_directory)`` list the same
    for any instant and rule; arguments left out have the views' values. They are called by their
    bare names, with the database as the current one. Constant arguments become constants of the
    plan, so they are pushed down as those of the views are. Days are those of the reading
    session's zone, which should be UTC.
    """
    tables = {name: f"{database}.`{table}`" for name, table in names.items()}

    def is_on(name: str, alias: str = "") -> str:
        column = f"{alias}active"
        kind = spark.table(tables[name]).schema["active"].dataType
        if isinstance(kind, T.BooleanType):
            return column
        return f"{column} = 'T'" if isinstance(kind, T.StringType) else f"{column} = 1"

    values = {
        "account_open": is_on("account"),
        "account_open_a": is_on("account", "a."),
        "directory_open": is_on("directory"),
        "directory_open_d": is_on("directory", "d."),
        "role": _text(defaults.LICENCE_ROLE),
        "database": database,
        "default_months": defaults.TRACKER_MONTHS,
        "default_exempt": _text(defaults.EXEMPT_GROUP),
        "granting": ", ".join(map(_text, defaults.ACCESS_PERMISSIONS)),
        "login": _text(defaults.LAST_LOGIN_ATTRIBUTE),
        "auth": _text(defaults.LAST_AUTH_ATTRIBUTE),
        "first": FIRST_MILLIS,
        "last": LAST_MILLIS,
        "assignee": _text(defaults.ASSIGNEE_FIELD),
        "watching": _text(defaults.WATCH_ASSOCIATION),
        "audited": _text(defaults.AUDIT_ACCOUNT_TYPE),
        "reactivated": _text(defaults.REACTIVATION_SUFFIX),
        "writable": defaults.WRITABLE_DIRECTORY,
        "suffix": _text(email_suffix),
        "dormant": f"{database}.{DORMANT_VIEW}",
    }
    now = {"as_of": "current_timestamp()", "months": defaults.TRACKER_MONTHS, "exempt": _text(defaults.EXEMPT_GROUP)}
    for view, sql in ((ACTIVE_VIEW, _ACTIVE), (DORMANT_VIEW, _DORMANT), (EXTERNAL_VIEW, _EXTERNAL)):
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{view} AS {sql.format(**tables, **values, **now)}")
    given = {"as_of": "as_of", "months": "months", "exempt": "exempt_group"}
    for function, sql in ((DORMANT_FUNCTION, _DORMANT_AT), (EXTERNAL_FUNCTION, _EXTERNAL_AT)):
        spark.sql(sql.format(**tables, **values, **given, function=function))
