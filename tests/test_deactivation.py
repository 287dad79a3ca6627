from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from dormouse.plans.deactivation import accounts_after, deactivation_plan, deactivation_summary
from tests.build import account, tracker


def fixture(spark):
    accounts = [
        account(1, "ann"),
        account(2, "bob", active=0),
        account(3, "cat", directory=2),
        account(4, "dan", directory=2, active=0), account(5, "dan"),
        account(6, "eve", directory=3), account(7, "eve"),
    ]
    directories = [
        dict(id=1, active=1, directory_position=1),
        dict(id=2, active=1, directory_position=0),
        dict(id=3, active=0, directory_position=-1),
    ]
    tables = tracker(spark, account=accounts, directory=directories)
    names = spark.createDataFrame(
        [("ann", "2020-01-01"), ("bob", None), ("cat", None), ("dan", None), ("eve", None),
         ("zoe", None), (None, None)],
        "user_name string, lastlogin string",
    )
    return tables, deactivation_plan(names, tables["account"], tables["directory"])


def test_status_and_text_of_every_case(spark):
    _, plan = fixture(spark)
    found = {row.user_name: (row.account_id, row.status, row.detail) for row in plan.collect()}
    assert found == {
        "ann": (1, "deactivated", "Deactivated ann: lastlogin=2020-01-01"),
        "bob": (2, "already_inactive", "Failed to deactivate bob: Already inactive"),
        "cat": (3, "validation_failed", "Failed to deactivate cat: directory is read-only"),
        "dan": (4, "already_inactive", "Failed to deactivate dan: Already inactive"),
        "eve": (7, "deactivated", "Deactivated eve: lastlogin=null"),
        "zoe": (None, "not_found", "Failed to deactivate zoe: Not found"),
        None: (None, "not_found", "Failed to deactivate null: Not found"),
    }


def test_names_alone_are_enough(spark):
    tables, _ = fixture(spark)
    names = spark.createDataFrame([("ann",)], "user_name string")
    plan = deactivation_plan(names, tables["account"], tables["directory"])
    assert [row.detail for row in plan.collect()] == ["Deactivated ann"]


def test_all_errors_of_an_account_are_listed(spark):
    tables, _ = fixture(spark)
    names = spark.createDataFrame([("cat",)], "user_name string")
    checks = {"no address": F.col("email_address").isNull(), "old": F.col("created_date") < "2020-01-01"}
    plan = deactivation_plan(names, tables["account"], tables["directory"], checks=checks)
    assert [row.detail for row in plan.collect()] == [
        "Failed to deactivate cat: directory is read-only,old"
    ]


def test_writable_directories(spark):
    tables, _ = fixture(spark)
    names = spark.createDataFrame([("cat",), ("ann",)], "user_name string")
    plan = deactivation_plan(names, tables["account"], tables["directory"], [2])
    assert {r.user_name: r.status for r in plan.collect()} == {
        "cat": "deactivated", "ann": "validation_failed"
    }


def test_summary(spark):
    _, plan = fixture(spark)
    assert sorted(map(tuple, deactivation_summary(plan).collect())) == [
        ("already_inactive", 2, None),
        ("deactivated", 2, "2 inactive users automatically deactivated."),
        ("not_found", 2, None),
        ("validation_failed", 1, None),
    ]


def test_only_the_resolved_accounts_change(spark):
    tables, plan = fixture(spark)
    before = {row.id: row for row in tables["account"].collect()}
    after = {row.id: row for row in accounts_after(tables["account"], plan).collect()}
    assert before.keys() == after.keys()
    changed = {key for key in before if before[key] != after[key]}
    assert changed == {1, 7}
    assert not any(after[key].is_active for key in changed)


def test_names_are_looked_up_in_any_case(spark):
    tables = tracker(spark, account=[account(1, "Ann"), account(2, "ann", directory=2)])
    names = spark.createDataFrame([("Ann",)], "user_name string")
    row, = deactivation_plan(names, tables["account"], tables["directory"]).collect()
    assert (row.user_name, row.account_id, row.status) == ("Ann", 2, "validation_failed")


@pytest.mark.parametrize(
    ("kind", "on", "off"),
    [("int", 1, 0), ("bigint", 1, 0), ("decimal(9,0)", 1, 0), ("string", "T", "F"), ("boolean", True, False)],
)
def test_whole_account_table_is_kept_in_its_own_coding(spark, kind, on, off):
    rows = [(9, on, 1, "x", "Ann"), (8, off, 2, None, "Bob"), (7, on, 3, "z", "Cat")]
    accounts = spark.sql(
        "SELECT * FROM VALUES " + ", ".join(
            f"({c}, CAST({'NULL' if a is None else repr(a)} AS {kind}), CAST({i} AS decimal(18,0)), "
            f"{'NULL' if e is None else repr(e)}, '{n}')" for c, a, i, e, n in rows
        ) + " AS t(credential, Active, ID, `external.id`, _switched_off)"
    )
    plan = spark.createDataFrame([(1, "deactivated"), (3, "validation_failed")], "account_id long, status string")
    after = accounts_after(accounts, plan)
    assert after.schema.simpleString() == accounts.schema.simpleString()
    found = {int(r.ID): r for r in after.collect()}
    before = {int(r.ID): r for r in accounts.collect()}
    assert found[1].Active == off and found[2] == before[2] and found[3] == before[3]
    assert found[1].credential == 9 and found[1]["external.id"] == "x"


def test_name_listed_twice_changes_one_row(spark):
    tables, plan = fixture(spark)
    assert accounts_after(tables["account"], plan.unionAll(plan)).count() == 7
