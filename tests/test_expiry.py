"""The instant an account becomes dormant, and the index of accounts by that day."""

from __future__ import annotations

import calendar
import re
from datetime import date, datetime, time, timedelta

import pytest
from pyspark.sql import functions as F

from dormouse.functions.time import first_after_months
from dormouse.plans.dormancy import dormant_accounts
from dormouse.plans.expiry import account_expiries, dormant_at, expiry_index, newly_dormant, write_expiry_index
from tests.build import account, files_read, last_login, member, millis, names, tracker

TICK = timedelta(microseconds=1)


def cut(moment: datetime, months: int) -> datetime:
    """Calendar months before, clamped to the end of the month."""
    number = moment.year * 12 + moment.month - 1 - months
    year, month = divmod(number, 12)
    day = min(moment.day, calendar.monthrange(year, month + 1)[1])
    return moment.replace(year=year, month=month + 1, day=day)


def first_dormant(moment: datetime, months: int) -> datetime:
    """The first instant whose cut is after the moment, looked for day by day."""
    day = datetime.combine(moment.date(), time()) + timedelta(days=28 * months - 5 if months else 0)
    while not cut(day + timedelta(days=1) - TICK, months) > moment:
        day += timedelta(days=1)
    if cut(day, months) > moment:
        return day
    return datetime.combine(day.date(), moment.time()) + TICK


@pytest.mark.parametrize("months", [0, 1, 3, 6, 12, 13])
def test_first_instant_after_the_period(spark, months):
    days = [date(2023, 1, 1) + timedelta(days=n) for n in range(800)]
    times = [time(), time(6), time(23, 59, 59, 999999), time(23, 59, 59, 999998)]
    moments = [datetime.combine(day, t) for day in days for t in times]
    rows = spark.createDataFrame([(str(m),) for m in moments], "t string").select(
        "t", F.col("t").cast("timestamp").alias("m")
    )
    found = {
        r.t: r.e for r in rows.select("t", first_after_months(F.col("m"), months).cast("string").alias("e")).collect()
    }
    for moment in moments:
        wanted = first_dormant(moment, months)
        assert datetime.fromisoformat(found[str(moment)]) == wanted
        assert cut(wanted, months) > moment and not cut(wanted - TICK, months) > moment


def people(spark, *moments, **more):
    accounts = [account(n + 1, f"u{n}", created="2000-01-01") for n in range(len(moments))]
    attrs = [last_login(a, millis(m)) for a, m in zip(accounts, moments) if m is not None]
    return tracker(spark, account=accounts, membership=[member(a) for a in accounts], attrs=attrs, **more)


ENDS = [
    "2024-02-28 06:00:00", "2024-02-29 00:00:00", "2024-02-29 06:00:00", "2024-02-29 23:59:59.999",
    "2024-03-01 00:00:00", "2024-02-27 23:00:00", "2023-11-30 12:00:00", None, "2023-08-31 06:00:00",
]


@pytest.mark.parametrize("as_of", [
    "2024-05-28 06:00:00", "2024-05-29 00:00:00", "2024-05-29 07:00:00", "2024-05-30 01:00:00",
    "2024-05-31 06:00:00", "2024-05-31 23:59:59.999999", "2024-06-01", "2024-02-29 12:00:00", "2023-11-30 06:00:00.000001",
])
def test_list_at_an_instant_equals_the_full_run(spark, as_of):
    tables = people(spark, *ENDS)
    full = dormant_accounts(tables, as_of)
    found = dormant_at(account_expiries(tables), as_of)
    assert found.columns == full.columns
    assert sorted(map(repr, found.collect())) == sorted(map(repr, full.collect()))


@pytest.mark.parametrize(("since", "as_of"), [
    ("2024-05-28 12:00:00", "2024-05-29 01:00:00"), ("2024-05-29 01:00:00", "2024-05-31 07:00:00"),
    ("2024-05-31 01:00:00", "2024-05-31 07:00:00"), ("2024-05-30 05:00:00", "2024-06-01 00:00:00"),
    ("2024-02-29 11:00:00", "2024-02-29 13:00:00"), ("2023-01-01", "2025-01-01"), ("2025-01-01", "2025-02-28"),
    ("2024-05-31 07:00:00", "2024-05-31 07:00:00"),
])
def test_newly_dormant_is_the_difference_of_two_full_runs(spark, since, as_of):
    tables = people(spark, *ENDS)
    before, after = (set(names(dormant_accounts(tables, moment))) for moment in (since, as_of))
    assert set(names(newly_dormant(account_expiries(tables), since, as_of))) == after - before


def test_those_never_listed_are_not_in_the_index(spark):
    accounts = [account(1, "ann"), account(2, "bob", created=None), account(3, "eve", active=0), account(4, "out")]
    members = [member(a) for a in accounts[:3]] + [member(accounts[0], "never-deactivate", 7)]
    assert account_expiries(tracker(spark, account=accounts, membership=members)).count() == 0


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_index_is_read_by_the_days_between(spark, tmp_path):
    moments = [f"2023-{month:02d}-{day:02d} 06:00:00" for month in range(1, 13) for day in (1, 15, 28)]
    tables = people(spark, *moments)
    path = str(tmp_path / "index")
    write_expiry_index(account_expiries(tables), path)
    index = expiry_index(spark, path)
    assert len(files_read(index)) == len(moments)
    found = newly_dormant(index, "2023-09-10", "2023-09-20")
    assert names(found) == ["u16"] and len(files_read(found)) == 1
    partition_filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan_of(found)).group(1)
    assert "expires_on" in partition_filters and "add_months" not in partition_filters
    for since, as_of in (("2023-05-31 05:00:00", "2023-06-30"), ("2024-02-29", "2024-03-31")):
        wanted = set(names(dormant_accounts(tables, as_of))) - set(names(dormant_accounts(tables, since)))
        assert set(names(newly_dormant(index, since, as_of))) == wanted
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        expiry_index(spark, path, months=6)


def test_a_day_that_a_third_of_all_accounts_expire_on_is_several_files(spark, tmp_path, settings):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="2k")
    rows = spark.range(3000).selectExpr(
        "concat('u', id) AS user_name", "rpad('', 60, uuid()) AS email_address",
        "date_add(DATE'2024-01-01', if(id % 3 = 0, 0, cast(id % 5 as int))) AS expires_on",
    )
    write_expiry_index(rows, str(tmp_path / "index"))
    index = expiry_index(spark, str(tmp_path / "index"))
    assert index.count() == 3000
    assert len(files_read(index.filter("expires_on = DATE'2024-01-01'"))) > 1


def test_other_periods(spark):
    tables = people(spark, *ENDS)
    for months in (1, 6):
        full = dormant_accounts(tables, "2024-08-29 05:00:00", months=months)
        assert names(dormant_at(account_expiries(tables, months), "2024-08-29 05:00:00", months)) == names(full)
