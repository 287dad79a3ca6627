"""Every registered query against its SQL equivalent, over whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from sample.queries import QUERIES
from sample.oracle import ORACLE_SQL
from sample.check import connect, differences

SF_DIR = "/root/testdata/sf0.01"

EXPECTED_ROWS = {
    "access_members": 1358,
    "canonical_account": 1001,
    "last_assignment": 543,
    "last_watch": 150,
    "last_reactivation": 742,
    "exempt_accounts": 102,
    "assignee_count": 1499,
    "dormant_accounts": 624,
    "dormant_external": 403,
    "wiki_global_groups": 5,
    "wiki_last_edit": 1055,
    "wiki_dormant": 344,
    "wiki_dormant_strict": 1090,
    "licensed_accounts": 819,
    "dormant_by_login_rule": 860,
    "account_expiry": 914,
    "newly_dormant": 86,
    "activity_from_state": 1782,
    "rejected_logins": 268,
}


@pytest.fixture(scope="module")
def connection():
    with connect(SF_DIR) as opened:
        yield opened


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert differences(spark, connection, name, SF_DIR) is None


@pytest.mark.parametrize("name", sorted(EXPECTED_ROWS))
def test_row_counts(connection, name):
    sql = entry.oracle_sql()[name]
    assert connection.execute(f"SELECT count(*) FROM ({sql})").fetchall() == [
        (EXPECTED_ROWS[name],)
    ]


def test_flagship(spark):
    assert entry.entry(spark).count() == 56
