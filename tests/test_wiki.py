from __future__ import annotations

import pytest

from dormouse.plans.wiki import wiki_dormant, wiki_global_groups
from tests.build import account, utc, wiki, wiki_account

AS_OF = "2024-06-01"


def setup(spark, login="2020-01-01", edit=None, active="T", name="Ann", logins=None, **rows):
    """One user with a login row; ``login=None`` gives a row without a date."""
    ann = wiki_account(1, name, active=active)
    if logins is None:
        logins = [dict(username="K1", successdate=None if login is None else utc(login))]
    return wiki(
        spark,
        account=[ann],
        membership=[dict(child_id=1, parent_id=5)],
        user_mapping=[dict(user_key="K1", lower_username=name.lower())],
        logininfo=logins,
        content=[] if edit is None else [dict(lastmodifier="K1", lastmoddate=utc(edit))],
        **rows,
    )


def listed(tables, **options):
    return [row.mention for row in wiki_dormant(tables, AS_OF, **options).collect()]


@pytest.mark.parametrize(
    ("login", "edit", "default", "strict"),
    [
        ("2020-01-01", "2020-02-01", True, True),
        ("2020-01-01", "2024-05-01", False, False),
        ("2020-01-01", None, False, True),  # never edited a page
        (None, "2024-05-01", True, False),  # login without a date
        (None, None, True, True),
        ("2024-05-01", "2020-01-01", False, False),
        ("2023-12-01", "2020-01-01", False, False),  # exactly at the cutoff
        ("2020-01-01", "2023-12-01", False, False),
    ],
)
def test_rules(spark, login, edit, default, strict):
    tables = setup(spark, login, edit)
    assert listed(tables) == (["[~Ann]"] if default else [])
    assert listed(tables, strict=True) == (["[~Ann]"] if strict else [])


def test_user_without_a_login_row_is_never_listed(spark):
    tables = setup(spark, logins=[], edit="2020-01-01")
    assert listed(tables) == [] and listed(tables, strict=True) == []


def test_inactive_user_is_not_listed(spark):
    assert listed(setup(spark, active="F", edit="2020-01-01")) == []


def test_logins_of_one_day_give_one_row_and_of_two_days_two(spark):
    logins = [
        dict(username="K1", successdate=utc(when))
        for when in ("2020-01-01T08:00:00", "2020-01-01T09:00:00", "2020-01-02T09:00:00")
    ]
    tables = setup(spark, logins=logins, edit="2020-01-01")
    rows = wiki_dormant(tables, AS_OF).collect()
    assert [row.lastlogin for row in rows] == ["2020-01-02", "2020-01-01"]


def test_group_bound_to_a_space_gives_no_access(spark):
    spaces = [dict(permgroupname="staff", spaceid=77)]
    assert listed(setup(spark, edit="2020-01-01", spaceperm=spaces)) == []


def test_global_groups_are_listed_once(spark):
    rows = [dict(permgroupname="staff", spaceid=None)] * 2 + [dict(permgroupname="x", spaceid=1)]
    tables = wiki(spark, spaceperm=rows)
    assert wiki_global_groups(tables["spaceperm"]).collect() == [("staff",)]


def test_exempt_user(spark):
    tables = wiki(
        spark,
        account=[wiki_account(1, "ann"), wiki_account(2, None)],
        membership=[dict(child_id=1, parent_id=5), dict(child_id=1, parent_id=7),
                    dict(child_id=2, parent_id=7)],
        user_mapping=[dict(user_key="K1", lower_username="ann")],
        logininfo=[dict(username="K1", successdate=None)],
    )
    assert listed(tables) == []


def test_one_row_per_directory_of_a_user(spark):
    accounts = [wiki_account(1, "ann"), wiki_account(2, "ann", directory=2)]
    tables = wiki(
        spark,
        account=accounts,
        directory=[dict(id=1, directory_name="Main"), dict(id=2, directory_name="Other")],
        membership=[dict(child_id=n, parent_id=5) for n in (1, 2)],
        user_mapping=[dict(user_key="K1", lower_username="ann")],
        logininfo=[dict(username="K1", successdate=None)],
    )
    rows = wiki_dormant(tables, AS_OF).collect()
    assert [row.directory_name for row in rows] == ["Main", "Other"]


def test_account_without_a_name_has_no_mention(spark):
    row = account(1, "ann")
    assert row["lower_user_name"] == "ann"
    del row["display_name"]
    nameless = {**row, "user_name": None, "active": "T"}
    tables = wiki(
        spark,
        account=[nameless],
        membership=[dict(child_id=1, parent_id=5)],
        user_mapping=[dict(user_key="K1", lower_username="ann")],
        logininfo=[dict(username="K1", successdate=None)],
    )
    assert listed(tables) == [None]
