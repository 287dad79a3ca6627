"""Small hand-written tables; columns that a test does not mention are NULL."""

from __future__ import annotations

from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dormouse.sources.schemas import TRACKER, WIKI
from dormouse.sources.tables import Tables

ARROW = {
    T.LongType(): pa.int64(),
    T.IntegerType(): pa.int32(),
    T.StringType(): pa.string(),
    T.TimestampType(): pa.timestamp("us", "UTC"),
}


def utc(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def millis(text: str) -> str:
    return str(int(utc(text).timestamp() * 1000))


def tables(spark: SparkSession, schemas, **rows) -> Tables:
    def open_table(name):
        schema = schemas[name]
        given = rows.get(name, [])
        unknown = {key for row in given for key in row} - set(schema.fieldNames())
        assert not unknown, unknown
        arrow = pa.schema([(field.name, ARROW[field.dataType]) for field in schema])
        return spark.createDataFrame(pa.Table.from_pylist(given, arrow))

    return Tables(schemas, open_table)


def tracker(spark: SparkSession, **rows) -> Tables:
    """Tracker tables with two active directories, the second one first by position."""
    rows.setdefault(
        "directory",
        [
            dict(id=1, active=1, directory_position=1),
            dict(id=2, active=1, directory_position=0),
        ],
    )
    rows.setdefault("globalperm", [dict(permission="USE", group_id="staff")])
    rows.setdefault("grp", [dict(id=7, group_name="never-deactivate")])
    return tables(spark, TRACKER, **rows)


def wiki(spark: SparkSession, **rows) -> Tables:
    rows.setdefault("directory", [dict(id=1, directory_name="Main")])
    rows.setdefault(
        "grp",
        [
            dict(id=5, group_name="Staff", lower_group_name="staff"),
            dict(id=7, group_name="never-deactivate", lower_group_name="never-deactivate"),
        ],
    )
    rows.setdefault("spaceperm", [dict(permgroupname="staff", spaceid=None)])
    return tables(spark, WIKI, **rows)


def account(id, name, directory=1, active=1, created="2000-01-01", email="x@customer.example"):
    return dict(
        id=id,
        directory_id=directory,
        user_name=name,
        lower_user_name=None if name is None else name.lower(),
        email_address=email,
        display_name=name,
        active=active,
        created_date=None if created is None else utc(created),
    )


def wiki_account(id, name, active="T", **more):
    row = account(id, name, active=active, **more)
    del row["display_name"]
    return row


def member(account_row, parent="staff", parent_id=5):
    return dict(
        child_id=account_row["id"],
        lower_child_name=account_row["lower_user_name"],
        directory_id=account_row["directory_id"],
        parent_id=parent_id,
        lower_parent_name=parent,
    )


def attribute(account_row, name, value):
    return dict(
        user_id=account_row["id"],
        directory_id=account_row["directory_id"],
        attribute_name=name,
        attribute_value=value,
    )


def last_login(account_row, value):
    return attribute(account_row, "login.lastLoginMillis", value)


def names(frame) -> list:
    return sorted(row["user_name"] for row in frame.collect())


def files_read(frame) -> set[str]:
    """The files that rows of the result come from."""
    return {row.f for row in frame.select(F.input_file_name().alias("f")).distinct().collect()}
