from __future__ import annotations

import pytest

from dormouse.plans.login_rule import (
    dormant_by_login_rule,
    login_rule_counts,
    login_rule_verdicts,
)
from tests.build import account, last_login, millis, names, tracker, utc

AS_OF = "2024-06-01"


def verdict(spark, value="missing", created="2000-01-01", as_of=AS_OF):
    ann = account(1, "ann", created=created)
    attrs = [] if value == "missing" else [last_login(ann, value)]
    row, = login_rule_verdicts(tracker(spark, account=[ann], attrs=attrs), as_of).collect()
    return row.reason, row.is_dormant


@pytest.mark.parametrize(
    ("value", "created", "expected"),
    [
        (millis("2023-05-31"), "2000-01-01", ("login", True)),
        (millis("2023-06-01"), "2000-01-01", ("login", False)),
        ("missing", "2000-01-01", ("never_logged_in", True)),
        (None, "2000-01-01", ("never_logged_in", True)),
        ("", "2000-01-01", ("never_logged_in", True)),
        ("", "2024-01-01", ("never_logged_in", False)),
        ("", None, ("never_logged_in", False)),
        (" 12 ", "2024-01-01", ("login", True)),
        ("abc", "2000-01-01", ("unparseable", False)),
        ("1.5", "2000-01-01", ("unparseable", False)),
        ("1e30", "2000-01-01", ("unparseable", False)),
        ("9" * 20, "2000-01-01", ("unparseable", False)),
        ("9223372036854775807", "2000-01-01", ("unparseable", False)),
        ("-9223372036854775808", "2000-01-01", ("unparseable", False)),
        ("NaN", "2000-01-01", ("unparseable", False)),
        ("Infinity", "2000-01-01", ("unparseable", False)),
    ],
)
def test_verdicts(spark, value, created, expected):
    assert verdict(spark, value, created) == expected


def test_year_is_added_to_the_leap_day(spark):
    assert verdict(spark, millis("2024-02-29"), as_of="2025-02-28 12:00:00") == ("login", True)
    assert verdict(spark, millis("2024-02-29"), as_of="2025-02-28 00:00:00") == ("login", False)


def test_login_is_that_of_the_resolved_account_and_creation_that_of_the_checked_one(spark):
    first = account(1, "ann", directory=2, created="2024-01-01", active=0)
    checked = account(2, "ann", created="2000-01-01")
    recent = [last_login(first, millis("2024-05-01")), last_login(checked, "5")]
    assert names(dormant_by_login_rule(tracker(spark, account=[first, checked], attrs=recent), AS_OF)) == []
    none = tracker(spark, account=[first, checked], attrs=[last_login(checked, millis("2024-05-01"))])
    row, = dormant_by_login_rule(none, AS_OF).collect()
    assert (row.user_name, row.reason, row.created_date.year) == ("ann", "never_logged_in", 2000)


def test_name_without_an_account_in_an_active_directory_is_never_dormant(spark):
    ann = account(1, "ann")
    shut = [dict(id=1, active=0, directory_position=0)]
    tables = tracker(spark, account=[ann], directory=shut, attrs=[last_login(ann, millis("2000-01-02"))])
    row, = login_rule_verdicts(tables, AS_OF).collect()
    assert (row.reason, row.is_dormant, row.last_used) == ("unresolved", False, None)


def test_names_are_looked_up_in_any_case(spark):
    first, checked = account(1, "ann", directory=2), account(2, "Ann")
    recent = [last_login(first, millis("2024-05-01")), last_login(checked, "5")]
    tables = tracker(spark, account=[first, checked], attrs=recent)
    row, = login_rule_verdicts(tables, AS_OF).collect()
    assert (row.user_name, row.reason, row.is_dormant) == ("Ann", "login", False)


def test_other_directories_and_inactive_accounts_are_not_checked(spark):
    tables = tracker(spark, account=[account(1, "ann", directory=2), account(2, "bob", active=0)])
    assert login_rule_verdicts(tables, AS_OF).count() == 0


def test_counts_include_skipped_values(spark):
    people = [account(n, f"u{n}") for n in range(4)]
    attrs = [last_login(people[0], "abc"), last_login(people[1], millis("2024-05-01")),
             last_login(people[2], "5")]
    counts = login_rule_counts(login_rule_verdicts(tracker(spark, account=people, attrs=attrs), AS_OF))
    assert sorted(map(tuple, counts.collect())) == [
        ("login", 2, 1), ("never_logged_in", 1, 1), ("unparseable", 1, 0)
    ]


def test_duplicate_values_take_the_largest_number(spark):
    ann = account(1, "ann")
    rows = [last_login(ann, value) for value in ("abc", "999", millis("2024-05-01"), None)]
    row, = login_rule_verdicts(tracker(spark, account=[ann], attrs=rows), AS_OF).collect()
    assert (row.reason, row.last_used.astimezone(utc(AS_OF).tzinfo)) == ("login", utc("2024-05-01"))
