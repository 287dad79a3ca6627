from __future__ import annotations

from dormouse.operators import identity
from dormouse.plans.dormancy import canonical_eligible, dormant_accounts, dormant_external
from tests.build import account, member, names, tracker

AS_OF = "2024-06-01"


def chosen(spark, accounts, members, **rows):
    tables = tracker(spark, account=accounts, membership=members, **rows)
    return [(row.user_name, row.id) for row in canonical_eligible(tables).collect()]


def test_inactive_account_in_first_directory_gives_way(spark):
    first, second = account(1, "ann", directory=2, active=0), account(2, "ann", directory=1)
    assert chosen(spark, [first, second], [member(first), member(second)]) == [("ann", 2)]


def test_first_directory_wins(spark):
    first, second = account(1, "ann", directory=2), account(2, "ann", directory=1)
    assert chosen(spark, [first, second], [member(first), member(second)]) == [("ann", 1)]


def test_inactive_directory_gives_way(spark):
    first, second = account(1, "ann", directory=2), account(2, "ann", directory=1)
    directories = [
        dict(id=1, active=1, directory_position=1),
        dict(id=2, active=0, directory_position=0),
    ]
    found = chosen(spark, [first, second], [member(first), member(second)], directory=directories)
    assert found == [("ann", 2)]


def test_access_only_in_second_directory(spark):
    first, second = account(1, "ann", directory=2), account(2, "ann", directory=1)
    assert chosen(spark, [first, second], [member(second)]) == [("ann", 2)]


def test_group_without_access_does_not_count(spark):
    only = account(1, "ann")
    assert chosen(spark, [only], [member(only, parent="guests")]) == []


def test_permission_of_another_kind_does_not_count(spark):
    only = account(1, "ann")
    permission = [dict(permission="BULK_CHANGE", group_id="staff")]
    assert chosen(spark, [only], [member(only)], globalperm=permission) == []


def test_equal_positions_are_settled_by_directory_then_id(spark):
    directories = [dict(id=n, active=1, directory_position=0) for n in (1, 2)]
    rows = [account(9, "ann", directory=2), account(5, "ann"), account(4, "ann")]
    found = chosen(spark, rows, [member(row) for row in rows], directory=directories)
    assert found == [("ann", 4)]


def test_two_permitted_groups_give_one_row(spark):
    only = account(1, "ann")
    permissions = [dict(permission="USE", group_id="staff"),
                   dict(permission="ADMINISTER", group_id="admins")]
    members = [member(only), member(only, parent="admins")]
    assert chosen(spark, [only], members, globalperm=permissions) == [("ann", 1)]


def test_shadowed_account_is_not_listed_by_outer_filter(spark):
    # The account in the first directory stands for the person, so the outside
    # address of the shadowed account in directory 1 must not surface.
    first = account(1, "ann", directory=2, email="ann@mycompany.example")
    second = account(2, "ann", directory=1, email="ann@customer.example")
    tables = tracker(spark, account=[first, second], membership=[member(first), member(second)])
    dormant = dormant_accounts(tables, AS_OF)
    assert names(dormant) == ["ann"]
    assert names(dormant_external(dormant, "@mycompany.example")) == []


def test_missing_address_is_dormant_but_not_external(spark):
    only = account(1, "ann", email=None)
    tables = tracker(spark, account=[only], membership=[member(only)])
    dormant = dormant_accounts(tables, AS_OF)
    assert names(dormant) == ["ann"]
    assert names(dormant_external(dormant, "@mycompany.example")) == []


def test_exempt_group(spark):
    kept, listed = account(1, "ann"), account(2, "bob")
    members = [member(kept), member(listed), member(kept, parent="never-deactivate", parent_id=7)]
    tables = tracker(spark, account=[kept, listed], membership=members)
    assert names(dormant_accounts(tables, AS_OF)) == ["bob"]


def test_exempt_membership_in_any_directory_protects_the_name(spark):
    first, second = account(1, "ann", directory=2), account(2, "ann", directory=1)
    members = [member(first), member(second, parent="never-deactivate", parent_id=7)]
    tables = tracker(spark, account=[first, second], membership=members)
    assert names(dormant_accounts(tables, AS_OF)) == []


def test_null_name_in_exempt_list_removes_nobody(spark):
    accounts = spark.createDataFrame([("ann",), (None,)], "user_name string")
    exempt = spark.createDataFrame([(None,)], "user_name string")
    assert identity.not_exempt(accounts, exempt).count() == 2


def test_active_account_count(spark):
    tables = tracker(spark, account=[account(1, "a"), account(2, "b", active=0),
                                     account(3, "c", active=None)])
    assert identity.active_account_count(tables["account"]).collect() == [(1,)]
