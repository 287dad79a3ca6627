from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from dormouse.operators import activity
from dormouse.plans.dormancy import dormant_accounts
from tests.build import account, attribute, last_login, member, millis, names, tracker, utc

AS_OF = "2024-06-01"
REACTIVATED = '[{"name":"Active","from":"Inactive","to":"Active"}]'


def one_person(spark, name="ann", created="2000-01-01", **rows):
    person = account(1, name, created=created)
    return tracker(spark, account=[person], membership=[member(person)], **rows)


def stats(spark, *rows, lenient=False):
    tables = tracker(spark, account=[account(1, "ann")], attrs=list(rows))
    return activity.account_activity(tables["account"], tables["attrs"], lenient)


def login_text(spark, value, lenient=False):
    found = stats(spark, last_login(account(1, "ann"), value), lenient=lenient)
    text = F.date_format("lastlogin", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return found.select(text).collect()[0][0]


def test_fraction_of_a_millisecond_is_kept(spark):
    assert login_text(spark, "1700000000123.5") == "2023-11-14 22:13:20.123500"


def test_spaces_around_a_number(spark):
    assert login_text(spark, " 12 ") == "1970-01-01 00:00:00.012000"


@pytest.mark.parametrize("value", ["abc", ""])
def test_text_that_is_no_number(spark, value):
    with pytest.raises(PySparkException, match="of account 1 is not a time"):
        login_text(spark, value)
    assert login_text(spark, value, lenient=True) is None


def test_rejects_are_counted(spark):
    ann = account(1, "ann")
    tables = tracker(
        spark,
        attrs=[last_login(ann, "abc"), last_login(ann, ""), last_login(ann, "5"),
               attribute(ann, "lastAuthenticated", "x"), last_login(ann, None),
               attribute(ann, "passwordLastChanged", "y")],
    )
    assert activity.attribute_rejects(tables["attrs"]).collect() == [(2, 1)]


def test_bad_value_of_an_account_that_is_not_asked_for(spark):
    tables = one_person(spark, attrs=[last_login(account(99, "zoe"), "abc")])
    assert names(dormant_accounts(tables, AS_OF)) == ["ann"]


def test_latest_of_duplicate_attributes_is_a_number_comparison(spark):
    ann = account(1, "ann")
    found = stats(spark, last_login(ann, "999"), last_login(ann, "1000"))
    assert found.select(F.unix_millis("lastlogin")).collect() == [(1000,)]


def test_attribute_of_another_directory_does_not_count(spark):
    found = stats(spark, last_login(account(1, "ann", directory=2), "5"))
    assert found.select("lastlogin", "lastauth").collect() == [(None, None)]


def test_login_exactly_at_the_cutoff_is_not_dormant(spark):
    ann = account(1, "ann")
    for value, expected in [
        (millis("2024-03-01"), []),
        (str(int(millis("2024-03-01")) - 1), ["ann"]),
    ]:
        assert names(dormant_accounts(one_person(spark, attrs=[last_login(ann, value)]), AS_OF)) == expected


def test_recent_authentication_protects(spark):
    row = attribute(account(1, "ann"), "lastAuthenticated", millis("2024-05-01"))
    assert names(dormant_accounts(one_person(spark, attrs=[row]), AS_OF)) == []


def test_cutoff_is_clamped_to_the_end_of_the_month(spark):
    ann = account(1, "ann")
    on_the_day = one_person(spark, attrs=[last_login(ann, millis("2024-02-29"))])
    before = one_person(spark, attrs=[last_login(ann, millis("2024-02-28"))])
    assert names(dormant_accounts(on_the_day, "2024-05-31")) == []
    assert names(dormant_accounts(before, "2024-05-31")) == ["ann"]


@pytest.mark.parametrize("created", [None, "2024-04-01", "2024-03-01"])
def test_new_or_undated_account_is_not_dormant(spark, created):
    assert names(dormant_accounts(one_person(spark, created=created), AS_OF)) == []


def assigned(spark, name, when, value, field="assignee"):
    return one_person(
        spark,
        name=name,
        changegroup=[dict(id=1, created=utc(when))],
        changeitem=[dict(groupid=1, field=field, newvalue=value)],
    )


def test_recent_assignment_protects(spark):
    assert names(dormant_accounts(assigned(spark, "ann", "2024-05-01", "ann"), AS_OF)) == []


def test_assignment_by_key_or_of_another_field_does_not(spark):
    assert names(dormant_accounts(assigned(spark, "ann", "2024-05-01", "KEY1"), AS_OF)) == ["ann"]
    other = assigned(spark, "ann", "2024-05-01", "ann", field="status")
    assert names(dormant_accounts(other, AS_OF)) == ["ann"]


def test_unassignment_stays_a_row_of_its_own(spark):
    tables = assigned(spark, "ann", "2024-05-01", None)
    found = activity.last_assignment(tables["changegroup"], tables["changeitem"])
    assert found.select("user_name").collect() == [(None,)]


def reactivated(spark, name="ann", when="2024-05-01", text=REACTIVATED, kind="USER"):
    return one_person(
        spark,
        name=name,
        app_user=[dict(user_key="KEY1", lower_user_name=name.lower())],
        audit=[dict(entity_timestamp=int(millis(when)), primary_resource_id="KEY1",
                    primary_resource_type=kind, change_values=text)],
    )


def test_recent_reactivation_protects(spark):
    assert names(dormant_accounts(reactivated(spark), AS_OF)) == []


def test_reactivation_is_compared_by_day(spark):
    # Noon of the day before the cutoff and of the cutoff day itself.
    assert names(dormant_accounts(reactivated(spark, when="2024-02-29T12:00:00"), AS_OF)) == ["ann"]
    assert names(dormant_accounts(reactivated(spark, when="2024-03-01T12:00:00"), AS_OF)) == []
    # With a cutoff at noon, the day of the reactivation counts from midnight.
    later = reactivated(spark, when="2024-03-01T13:00:00")
    assert names(dormant_accounts(later, "2024-06-01 12:00:00")) == ["ann"]


def test_mixed_case_name_is_not_protected_by_reactivation(spark):
    assert names(dormant_accounts(reactivated(spark, name="Ann"), AS_OF)) == ["Ann"]


@pytest.mark.parametrize(
    "text", [REACTIVATED + "\n", REACTIVATED[:-1] + ',{"name":"x"}]', "", None]
)
def test_audit_text_must_end_with_the_change(spark, text):
    assert names(dormant_accounts(reactivated(spark, text=text), AS_OF)) == ["ann"]


def test_audit_of_a_group_is_no_reactivation(spark):
    assert names(dormant_accounts(reactivated(spark, kind="GROUP"), AS_OF)) == ["ann"]


def test_negative_epoch_is_cut_towards_zero(spark):
    rows = [dict(entity_timestamp=-500, primary_resource_id="KEY1",
                 primary_resource_type="USER", change_values=REACTIVATED)]
    tables = one_person(spark, audit=rows, app_user=[dict(user_key="KEY1", lower_user_name="ann")])
    found = activity.last_reactivation(tables["audit"], tables["app_user"])
    assert str(found.collect()[0].lastreactivate) == "1970-01-01"


def test_watch_is_shown_but_protects_nobody(spark):
    tables = one_person(
        spark,
        app_user=[dict(user_key="KEY1", lower_user_name="ann")],
        userassociation=[
            dict(source_name="KEY1", association_type="WatchIssue", created=utc("2024-05-20")),
            dict(source_name="KEY1", association_type="WatchIssue", created=utc("2024-05-10")),
            dict(source_name="KEY1", association_type="VoteIssue", created=utc("2024-05-30")),
        ],
    )
    assert [(r.user_name, r.lastwatch) for r in dormant_accounts(tables, AS_OF).collect()] == [
        ("ann", "2024-05-20")
    ]


def test_watch_reaches_every_spelling_of_a_name(spark):
    tables = tracker(
        spark,
        account=[account(1, "Ann"), account(2, "ann", directory=2), account(3, "ann")],
        app_user=[dict(user_key=key, lower_user_name="ann") for key in ("K1", "K2")],
        userassociation=[
            dict(source_name="K1", association_type="WatchIssue", created=utc("2024-05-20")),
            dict(source_name="K2", association_type="WatchIssue", created=utc("2024-05-21")),
        ],
    )
    found = activity.last_watch(tables["userassociation"], tables["app_user"], tables["account"])
    rows = sorted((r.user_name, r.lastwatch.day) for r in found.collect())
    assert rows == [("Ann", 21), ("ann", 21)]


def test_issue_count_is_zero_without_issues_and_by_name_only(spark):
    found = dormant_accounts(one_person(spark, issue=[dict(assignee="KEY1"), dict(assignee=None)]), AS_OF)
    assert [r.assigneecount for r in found.collect()] == [0]
    found = dormant_accounts(one_person(spark, issue=[dict(assignee="ann")] * 2), AS_OF)
    assert [r.assigneecount for r in found.collect()] == [2]


def test_order_is_by_day_then_name_with_never_last(spark):
    people = [account(n, name) for n, name in enumerate(["dan", "cat", "bob", "ann"])]
    attrs = [
        last_login(people[0], millis("2020-01-02")),
        last_login(people[1], millis("2020-01-01T08:00:00")),
        last_login(people[2], millis("2020-01-01T09:00:00")),
    ]
    tables = tracker(spark, account=people, membership=[member(p) for p in people], attrs=attrs)
    rows = dormant_accounts(tables, AS_OF).collect()
    assert [row.user_name for row in rows] == ["dan", "bob", "cat", "ann"]
    assert [row.lastlogin for row in rows] == ["2020-01-02", "2020-01-01", "2020-01-01", None]
