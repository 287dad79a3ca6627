from __future__ import annotations

from dormouse.plans.dormancy import licensed_accounts
from tests.build import account, member, names, tracker

ROLE = [dict(license_role_name="jira-software", group_id="staff")]


def test_membership_by_name_counts_across_directories(spark):
    held, other = account(1, "ann", directory=2, active=0), account(2, "ann", directory=1)
    tables = tracker(spark, account=[held, other], membership=[member(held)], license=ROLE)
    assert names(licensed_accounts(tables)) == ["ann"]


def test_accounts_alike_are_one_row_with_the_latest_creation(spark):
    rows = [account(1, "ann", created="2001-01-01"),
            account(2, "ann", directory=2, created="2002-01-01"),
            account(3, "ann", directory=2, created=None, email=None)]
    tables = tracker(spark, account=rows, membership=[member(rows[0])] * 2, license=ROLE)
    found = sorted((r.email_address or "", r.created_date and r.created_date.year)
                   for r in licensed_accounts(tables).collect())
    assert found == [("", None), ("x@customer.example", 2002)]


def test_other_roles_and_inactive_accounts_do_not_count(spark):
    rows = [account(1, "ann"), account(2, "bob", active=0)]
    members = [member(rows[0], parent="desk"), member(rows[1])]
    roles = ROLE + [dict(license_role_name="jira-servicedesk", group_id="desk")]
    tables = tracker(spark, account=rows, membership=members, license=roles)
    assert names(licensed_accounts(tables)) == []
    assert names(licensed_accounts(tables, role="jira-servicedesk")) == ["ann"]
