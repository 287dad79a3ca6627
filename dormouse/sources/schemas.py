"""Columns this library reads, per table, and what the source systems call them."""

from __future__ import annotations

from pyspark.sql import types as T

_LONG, _INT, _TEXT, _TIME = T.LongType(), T.IntegerType(), T.StringType(), T.TimestampType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_IDENTITY = dict(
    id=_LONG, directory_id=_LONG, user_name=_TEXT, lower_user_name=_TEXT, email_address=_TEXT,
)

TRACKER = {
    "account": _schema(**_IDENTITY, display_name=_TEXT, active=_INT, created_date=_TIME),
    "directory": _schema(id=_LONG, active=_INT, directory_position=_INT),
    "grp": _schema(id=_LONG, group_name=_TEXT),
    "membership": _schema(
        child_id=_LONG, lower_child_name=_TEXT, directory_id=_LONG,
        parent_id=_LONG, lower_parent_name=_TEXT,
    ),
    "globalperm": _schema(permission=_TEXT, group_id=_TEXT),
    "license": _schema(license_role_name=_TEXT, group_id=_TEXT),
    "attrs": _schema(user_id=_LONG, directory_id=_LONG, attribute_name=_TEXT, attribute_value=_TEXT),
    "changegroup": _schema(id=_LONG, created=_TIME),
    "changeitem": _schema(groupid=_LONG, field=_TEXT, newvalue=_TEXT),
    "app_user": _schema(user_key=_TEXT, lower_user_name=_TEXT),
    "userassociation": _schema(source_name=_TEXT, association_type=_TEXT, created=_TIME),
    "audit": _schema(
        entity_timestamp=_LONG, primary_resource_id=_TEXT,
        primary_resource_type=_TEXT, change_values=_TEXT,
    ),
    "issue": _schema(assignee=_TEXT),
}

WIKI = {
    "account": _schema(**_IDENTITY, active=_TEXT, created_date=_TIME),
    "directory": _schema(id=_LONG, directory_name=_TEXT),
    "grp": _schema(id=_LONG, group_name=_TEXT, lower_group_name=_TEXT),
    "membership": _schema(child_id=_LONG, parent_id=_LONG),
    "logininfo": _schema(username=_TEXT, successdate=_TIME),
    "user_mapping": _schema(user_key=_TEXT, lower_username=_TEXT),
    "spaceperm": _schema(permgroupname=_TEXT, spaceid=_LONG),
    "content": _schema(lastmodifier=_TEXT, lastmoddate=_TIME),
}

# Table names in the source databases.
SOURCE_NAMES = {
    "account": "cwd_user",
    "directory": "cwd_directory",
    "grp": "cwd_group",
    "membership": "cwd_membership",
    "globalperm": "globalpermissionentry",
    "license": "licenserolesgroup",
    "attrs": "cwd_user_attributes",
    "changegroup": "changegroup",
    "changeitem": "changeitem",
    "app_user": "app_user",
    "userassociation": "userassociation",
    "audit": "AO_C77861_AUDIT_ENTITY",
    "issue": "jiraissue",
    "logininfo": "logininfo",
    "user_mapping": "user_mapping",
    "spaceperm": "spacepermissions",
    "content": "content",
}

# Columns that a source database names differently.
SOURCE_COLUMNS = {"membership": {"child_user_id": "child_id"}}
