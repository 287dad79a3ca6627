"""A stored state of the latest activity, to which only new events are added."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import DataFrame

from dormouse.operators import activity, activity_state
from dormouse.operators.activity_state import Marks
from dormouse.plans.dormancy import dormant_accounts
from dormouse.sources.generations import published
from tests.build import account, member, tracker, utc


def made(spark, seed, end=1000):
    """Tables with events in any order; those numbered or dated beyond the end are still to come."""
    choose = random.Random(seed)
    people = [account(n, f"u{n}" if n % 3 else f"U{n}") for n in range(12)]
    groups, items, watches, audit = [], [], [], []
    for n in range(60):
        day = utc(f"2024-0{choose.randint(1, 9)}-{choose.randint(10, 28)}")
        groups.append(dict(id=n * 10, created=day if n % 11 else None))
        items += [
            dict(groupid=n * 10, field=choose.choice(["assignee", "status"]), newvalue=choose.choice([None, *(p["user_name"] for p in people)]))
            for _ in range(3)
        ]
        watches.append(dict(source_name=f"KEY{choose.randint(0, 14)}", association_type=choose.choice(["WatchIssue", "VoteIssue"]), created=day if n % 13 else None))
        audit.append(dict(
            entity_timestamp=int(day.timestamp() * 1000) + n if n % 17 else None, primary_resource_id=f"KEY{choose.randint(0, 14)}",
            primary_resource_type=choose.choice(["USER", "GROUP"]), change_values='[{"from":"Inactive","to":"Active"}]',
        ))
    groups = [g for g in groups if g["id"] <= end]
    limit = utc(f"2024-{min(9, 1 + end // 100):02d}-28")
    return tracker(
        spark, account=people, membership=[member(p) for p in people], changegroup=groups, changeitem=items,
        userassociation=[w for w in watches if w["created"] is None or w["created"] <= limit],
        audit=[a for a in audit if a["entity_timestamp"] is None or a["entity_timestamp"] <= limit.timestamp() * 1000],
        app_user=[dict(user_key=f"KEY{n}", lower_user_name=f"u{n}") for n in range(14)],
        issue=[dict(assignee=choose.choice([None, "u1", "u2"])) for _ in range(9)],
    )


def rows(frame: DataFrame) -> list[str]:
    return sorted(repr(r) for r in frame.select(*sorted(frame.columns)).collect())


@pytest.mark.parametrize("seed", range(4))
def test_state_and_two_additions_equal_the_full_query_for_any_cut(spark, seed):
    tables, choose = made(spark, seed), random.Random(seed)
    ends = activity_state.marks_of(tables)

    def some_cut():
        return Marks(*(choose.randint(0, end) for end in (ends.changegroup, ends.watch, ends.audit)))

    cuts = [some_cut(), some_cut()]
    low, high = (Marks(*(pick(pair) for pair in zip(*(vars(c).values() for c in cuts)))) for pick in (min, max))
    state = activity_state.merged(
        activity_state.latest_between(tables, until=low),
        activity_state.latest_between(tables, low, high),
        activity_state.latest_between(tables, high),
    )
    full = activity.activity_by_name(tables)
    assert rows(activity_state.activity_by_name(state, tables)) == rows(full)
    again = activity_state.merged(state, activity_state.latest_between(tables, low), state)
    assert rows(again) == rows(state)


def test_runs_add_what_came_since(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(activity_state, "MAX_GENERATIONS", 3)
    root = str(tmp_path / "state")
    counts = []
    for end in (200, 200, 330, 500, 700, 1000):
        tables = made(spark, 9, end)
        marks = activity_state.advance(tables, root)
        state = activity_state.stored_state(spark, root)
        assert marks == activity_state.marks_of(tables)
        assert rows(activity_state.activity_by_name(state, tables)) == rows(activity.activity_by_name(tables))
        counts.append(len(published(spark, root).places))
    assert counts == [1, 2, 3, 1, 2, 3]
    recent = activity_state.activity_by_name(state, tables)
    assert rows(dormant_accounts(tables, "2024-12-20", recent=recent)) == rows(dormant_accounts(tables, "2024-12-20"))


def test_a_run_that_ends_half_way_leaves_the_state_as_it_was(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "state")
    activity_state.advance(made(spark, 5, 300), root)
    before = rows(activity_state.stored_state(spark, root))

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(activity_state, "publish", fail)
        with pytest.raises(RuntimeError):
            activity_state.advance(made(spark, 5, 900), root)
    assert rows(activity_state.stored_state(spark, root)) == before
    tables = made(spark, 5, 700)
    activity_state.advance(tables, root)
    state = activity_state.stored_state(spark, root)
    assert rows(activity_state.activity_by_name(state, tables)) == rows(activity.activity_by_name(tables))


def test_only_new_events_are_read(spark, tracker_files, settings):
    settings(spark__sql__maxMetadataStringLength="2000")
    since = Marks(changegroup=700, watch=1_705_000_000_000_000, audit=900_000_000_000)
    plan = activity_state.latest_between(tracker_files, since)._jdf.queryExecution().executedPlan().toString()
    pushed = "\n".join(re.findall(r"PushedFilters: \[.*", plan)).replace(" ", "")
    assert "GreaterThan(id,700)" in pushed and "GreaterThan(groupid,700)" in pushed
    assert "Or(IsNull(entity_timestamp),GreaterThanOrEqual(entity_timestamp,900000000000))" in pushed


def test_empty_tables(spark, tmp_path):
    tables = tracker(spark)
    root = str(tmp_path / "state")
    assert activity_state.advance(tables, root) == Marks()
    assert activity_state.stored_state(spark, root).count() == 0
    with pytest.raises(ValueError, match="no state"):
        activity_state.stored_state(spark, f"{root}-none")
