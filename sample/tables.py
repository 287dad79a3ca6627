"""The account tables, derived with Spark from the Parquet files of the sample data."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dormouse.sources.tables import Tables

# Fixed values of the sample.
AS_OF = "2001-08-02 00:00:00"
SINCE = "2001-05-31 06:00:00"
# Where watches, in microseconds, and audit rows, in milliseconds, begin.
FIRST_WATCH, FIRST_AUDIT = 1_704_067_200_000_000, 788_918_400_000
INTERNAL_SUFFIX = "@mycompany.example"
EXTERNAL_SUFFIX = "@customer.example"
GROUPS = [
    (1, "building-users"),
    (2, "machinery-users"),
    (3, "household-users"),
    (4, "furniture-users"),
    (5, "automobile-users"),
    (6, "all-staff"),
    (900, "never-deactivate"),
]
PERMISSIONS = [
    ("USE", "building-users"),
    ("USE", "machinery-users"),
    ("USE", "household-users"),
    ("USE", "all-staff"),
    ("ADMINISTER", "machinery-users"),
    ("BULK_CHANGE", "furniture-users"),
]
LICENCES = [
    ("jira-software", "building-users"),
    ("jira-software", "machinery-users"),
    ("jira-software", "all-staff"),
    ("jira-servicedesk", "household-users"),
]
REACTIVATED = '[{"name":"Active","from":"Inactive","to":"Active"}]'
DEACTIVATED = '[{"name":"Active","from":"Active","to":"Inactive"}]'


# Columns used of the sample files; given, so that opening one reads nothing.
FILES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_nationkey INT, c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING",
}


def sample_tables(
    spark: SparkSession, sf_dir: str, schemas: Mapping[str, T.StructType]
) -> Tables:
    """Tables by name, each derived when first used."""
    source = Sample(spark, sf_dir)
    return Tables(schemas, lambda name: DERIVATIONS[name](source))


class Sample:
    """The sample files, each opened once."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.read = cache(
            lambda name: spark.read.schema(FILES[name]).parquet(f"{sf_dir}/{name}.parquet")
        )
        self.people = cache(lambda: _people(self))
        self.placed = cache(lambda: _placed(self))

    def constants(self, rows: list[tuple], *columns: str) -> DataFrame:
        """Fixed rows as an inline table, whose size the planner knows."""
        values = ", ".join(f"({', '.join(map(_literal, row))})" for row in rows)
        return self.spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def _literal(value: int | str | None) -> str:
    if value is None:
        return "NULL"
    return f"'{value}'" if isinstance(value, str) else f"{value}L"


def _people(sample: Sample) -> DataFrame:
    """Customers as people: key, user name, user key, segment and nation."""
    return sample.read("customer").selectExpr(
        "c_custkey AS k",
        "concat(if(c_custkey % 11 = 0, 'User', 'user'), c_custkey) AS nm",
        "if(c_custkey % 2 = 0, concat('user', c_custkey), concat('KEY', 10000 + c_custkey)) AS ukey",
        "c_mktsegment AS seg",
        "c_nationkey AS nk",
    )


def _placed(sample: Sample) -> DataFrame:
    """People once per directory they have an account in."""
    nations = sample.read("nation").selectExpr("n_nationkey AS nk", "n_regionkey AS rk")
    return (
        sample.people()
        .join(nations, "nk")
        .selectExpr(
            "*",
            "explode(if(k % 3 = 0 AND rk <> 0, array(1L, rk + 1L), array(1L))) AS d",
        )
        .selectExpr("*", "k + 1000000 * d AS id")
    )


def _account(sample: Sample) -> DataFrame:
    return sample.placed().selectExpr(
        "id",
        "d AS directory_id",
        "nm AS user_name",
        "lower(nm) AS lower_user_name",
        f"""CASE WHEN k % 17 <> 0 THEN
            concat(nm, if(nk % 5 = d % 5, '{INTERNAL_SUFFIX}', '{EXTERNAL_SUFFIX}')) END
            AS email_address""",
        "concat('Display ', k) AS display_name",
        "concat('ext-', k) AS external_id",
        "if(k % 23 = 0, NULL, k % 97) AS credential",
        "if((k % 13 = 0 AND d = 1) OR (k % 15 = 0 AND d <> 1), 0, 1) AS active",
        """CAST(CASE WHEN k % 29 = 0 THEN NULL
                     WHEN k % 7 = 0 THEN DATE'2001-06-15'
                     ELSE date_add(DATE'1996-01-01', CAST(k % 1000 AS INT)) END AS TIMESTAMP)
            AS created_date""",
    )


def _directory(sample: Sample) -> DataFrame:
    return sample.read("region").selectExpr(
        "r_regionkey + 1L AS id",
        "r_name AS directory_name",
        "if(r_regionkey = 4, 0, 1) AS active",
        "4 - r_regionkey AS directory_position",
    )


def _grp(sample: Sample) -> DataFrame:
    return sample.constants(GROUPS, "id", "group_name")


def _membership(sample: Sample) -> DataFrame:
    held = """array_compact(array(
        concat(lower(seg), '-users'),
        if(k % 4 = 0, 'all-staff', NULL),
        if(k % 19 = 0, 'never-deactivate', NULL)))"""
    groups = _grp(sample).withColumnRenamed("id", "parent_id")
    return (
        sample.placed()
        .selectExpr("id AS child_id", "lower(nm) AS lower_child_name", "d AS directory_id",
                    f"explode({held}) AS group_name")
        .join(groups, "group_name")
        .withColumnRenamed("group_name", "lower_parent_name")
    )


def _globalperm(sample: Sample) -> DataFrame:
    return sample.constants(PERMISSIONS, "permission", "group_id")


def _license(sample: Sample) -> DataFrame:
    return sample.constants(LICENCES, "license_role_name", "group_id")


def _attrs(sample: Sample) -> DataFrame:
    """A row per order and account; open orders are other attributes. Inactive accounts outside the first directory have odd logins."""
    millis = F.expr("unix_millis(CAST(o_orderdate AS TIMESTAMP))").alias("millis")
    orders = sample.read("orders").select("o_custkey", "o_orderstatus", millis)
    return sample.placed().join(orders, F.expr("o_custkey = k")).selectExpr(
        "id AS user_id",
        "d AS directory_id",
        """CASE WHEN o_orderstatus = 'F' AND (k % 5 <> 0 OR (k % 15 = 0 AND d <> 1))
                THEN 'login.lastLoginMillis'
                WHEN o_orderstatus = 'P' AND k % 5 <> 1 THEN 'lastAuthenticated'
                ELSE 'passwordLastChanged' END AS attribute_name""",
        """CASE WHEN o_orderstatus = 'P' THEN CAST(millis AS STRING)
                WHEN k % 15 = 0 AND d <> 1 THEN CASE k % 60
                    WHEN 0 THEN 'unknown' WHEN 15 THEN ''
                    WHEN 30 THEN '99999999999999999999' ELSE '9223372036854775807' END
                WHEN k % 37 <> 0 THEN CAST(millis + 123 AS STRING) END AS attribute_value""",
    )


def _changegroup(sample: Sample) -> DataFrame:
    return sample.read("orders").selectExpr("o_orderkey AS id", "o_orderdate AS created")


def _changeitem(sample: Sample) -> DataFrame:
    customers = sample.read("customer").agg(F.count("*")).scalar()
    people = sample.people().select("k", F.col("ukey").alias("newvalue"))
    return (
        sample.read("lineitem")
        .withColumn("k", F.col("l_partkey") % customers)
        .join(people, "k")
        .selectExpr(
            "l_orderkey AS groupid",
            """CASE WHEN l_linenumber <> 1 OR l_orderkey % 4 <> 0 THEN 'comment'
                    WHEN l_returnflag = 'R' THEN 'assignee'
                    WHEN l_returnflag = 'A' THEN 'status'
                    ELSE 'priority' END AS field""",
            "newvalue",
        )
    )


def _app_user(sample: Sample) -> DataFrame:
    return sample.people().selectExpr("ukey AS user_key", "lower(nm) AS lower_user_name")


def _user_mapping(sample: Sample) -> DataFrame:
    return sample.people().selectExpr("ukey AS user_key", "lower(nm) AS lower_username")


def _userassociation(sample: Sample) -> DataFrame:
    return (
        sample.read("events")
        .join(sample.people(), F.expr("user_id = k"))
        .selectExpr(
            "ukey AS source_name",
            "if(event_type = 'view', 'WatchIssue', 'VoteIssue') AS association_type",
            "ts AS created",
        )
    )


def _audit(sample: Sample) -> DataFrame:
    return (
        sample.read("orders")
        .join(sample.people(), F.expr("o_custkey = k"))
        .selectExpr(
            "unix_millis(CAST(o_orderdate AS TIMESTAMP)) + o_orderkey % 1000 AS entity_timestamp",
            "ukey AS primary_resource_id",
            """CASE WHEN o_orderpriority <> '1-URGENT' THEN 'PROJECT'
                    WHEN o_orderkey % 3 = 0 THEN 'GROUP'
                    ELSE 'USER' END AS primary_resource_type""",
            f"if(o_orderkey % 2 = 0, '{REACTIVATED}', '{DEACTIVATED}') AS change_values",
        )
    )


def _issue(sample: Sample) -> DataFrame:
    return sample.read("orders").selectExpr(
        "if(o_orderkey % 10 = 0, NULL, concat('user', o_custkey)) AS assignee"
    )


def _logininfo(sample: Sample) -> DataFrame:
    """A row per order; those of orders that are not finished are of users the key map no longer has."""
    return (
        sample.read("orders")
        .join(sample.people(), F.expr("o_custkey = k"))
        .selectExpr(
            "if(o_orderstatus = 'F', ukey, concat('gone-', ukey)) AS username",
            "if(k % 9 = 0, NULL, o_orderdate) AS successdate",
        )
    )


def _content(sample: Sample) -> DataFrame:
    return (
        sample.read("lineitem")
        .join(sample.read("orders"), F.expr("l_orderkey = o_orderkey"))
        .join(sample.people(), F.expr("o_custkey = k"))
        .selectExpr(
            "if(l_linestatus = 'O' AND k % 4 <> 0, ukey, NULL) AS lastmodifier",
            "l_shipdate AS lastmoddate",
        )
    )


def _spaceperm(sample: Sample) -> DataFrame:
    """Permissions of people's groups, some in a space and some in none; furniture always in one."""
    return sample.people().selectExpr(
        """inline(array_compact(array(
            struct(concat(lower(seg), '-users') AS permgroupname,
                   CASE WHEN seg = 'FURNITURE' OR k % 5 <> 0 THEN k % 50 END AS spaceid),
            CASE WHEN k % 4 = 0 THEN struct('all-staff' AS permgroupname,
                   CASE WHEN k % 20 <> 0 THEN k % 50 END AS spaceid) END)))"""
    )


DERIVATIONS: dict[str, Callable[[Sample], DataFrame]] = {
    "account": _account,
    "directory": _directory,
    "grp": _grp,
    "membership": _membership,
    "globalperm": _globalperm,
    "license": _license,
    "attrs": _attrs,
    "changegroup": _changegroup,
    "changeitem": _changeitem,
    "app_user": _app_user,
    "user_mapping": _user_mapping,
    "userassociation": _userassociation,
    "audit": _audit,
    "issue": _issue,
    "logininfo": _logininfo,
    "content": _content,
    "spaceperm": _spaceperm,
}
