"""Login values that cannot be read, kept apart as rows."""

from __future__ import annotations

import pytest

from dormouse.operators import activity, quarantine
from tests.build import account, attribute, files_read, millis, tracker

LOGIN = "login.lastLoginMillis"
REASONS = {
    None: "good", "0": "good", " 12 ": "good", "1.5": "good", millis("2024-01-01"): "good", "-62135596800000": "good",
    "": "empty", "  ": "empty", "abc": "not_a_number", "NaN": "not_a_number", "Infinity": "not_a_number", "12x": "not_a_number",
    "9" * 20: "out_of_range", "1e30": "out_of_range", "9" * 60: "out_of_range", "-62135596800001": "out_of_range",
}


@pytest.fixture
def tables(spark):
    people = [account(n, f"u{n}") for n in range(len(REASONS))]
    attrs = [attribute(p, name, value) for p, value in zip(people, REASONS) for name in (LOGIN, "lastAuthenticated", "other")]
    return tracker(spark, account=people, attrs=attrs)


def test_reasons(tables):
    found = quarantine.judged_values(tables["attrs"]).collect()
    assert {r.attribute_value: r.reason for r in found if r.attribute_name == LOGIN} == REASONS
    assert {r.reason for r in found if r.attribute_name == "other"} == {"good"}
    rejected = [value for value, reason in REASONS.items() if reason != "good"]
    assert sorted((r.attribute_value, r.reason) for r in quarantine.rejected_values(tables["attrs"]).collect()) == sorted(
        (value, REASONS[value]) for value in rejected * 2
    )


def test_good_rows_and_rejects_come_from_one_pass(spark, tables, tmp_path):
    path = tmp_path / "attrs"
    quarantine.write_split(tables["attrs"], str(path))
    assert {p.name for p in path.glob("reason=*")} == {
        "reason=good", "reason=empty", "reason=not_a_number", "reason=out_of_range"
    }
    good, rejected = quarantine.good_rows(spark, str(path)), quarantine.rejected_rows(spark, str(path))
    assert good.count() + rejected.count() == tables["attrs"].count()
    assert rejected.exceptAll(quarantine.rejected_values(tables["attrs"])).count() == 0
    assert all("reason=good" in f for f in files_read(good))
    # What is left is read without errors, and as lenient reading of all rows has it.
    accounts = tables["account"].select("id", "directory_id", "user_name")
    strict = activity.account_activity(accounts, good)
    lenient = activity.account_activity(accounts, tables["attrs"], lenient=True)
    assert strict.exceptAll(lenient).count() == lenient.exceptAll(strict).count() == 0
    with pytest.raises(Exception, match="is not a time"):
        activity.account_activity(accounts, tables["attrs"]).collect()


def test_counts_agree_with_the_rows(tables):
    counts = activity.attribute_rejects(tables["attrs"]).first()
    assert counts.lastlogin_rejects + counts.lastauth_rejects == quarantine.rejected_values(tables["attrs"]).count()
