"""What the physical plans must look like, with every join too large to broadcast."""

from __future__ import annotations

import re

import pytest

from dormouse.operators import activity
from dormouse.plans import deactivation, dormancy, login_rule, wiki

AS_OF = "2001-08-02"


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def no_broadcast(settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")


@pytest.fixture
def dormant_plan(tracker_files):
    return plan_of(dormancy.dormant_accounts(tracker_files, AS_OF, ordered=False))


def scans(plan: str, column: str) -> int:
    return len(re.findall(rf"FileScan parquet \[[^\]]*\b{column}#", plan))


def test_existence_is_tested_by_semi_and_anti_joins(dormant_plan):
    assert dormant_plan.count("LeftSemi") == 2
    assert dormant_plan.count("LeftAnti") == 1
    for unwanted in ("CartesianProduct", "NestedLoop", "Python"):
        assert unwanted not in dormant_plan


def test_first_account_is_chosen_on_both_sides_of_the_shuffle(dormant_plan):
    assert dormant_plan.count("WindowGroupLimit") == 2


def test_attributes_are_scanned_once_and_only_by_used_columns(dormant_plan):
    assert scans(dormant_plan, "attribute_value") == 1
    assert not re.search(r"FileScan[^\n]*display_name", dormant_plan)


def test_filters_reach_the_scans(dormant_plan):
    pushed = "\n".join(re.findall(r"PushedFilters: \[.*", dormant_plan))
    for expected in (
        "EqualTo(field,assignee)",
        "EqualTo(association_type,WatchIssue)",
        "EqualTo(primary_resource_type,USER)",
        "EqualTo(group_name,never-deactivate)",
        "EqualTo(active,1)",
        "In(attribute_name, [",
        "In(permission, [",
    ):
        assert expected in pushed, expected


def test_people_are_shuffled_once_for_all_joins_by_name(dormant_plan):
    # The choice of the account brings the people by name; beyond that there is
    # one exchange for all activity together and one for the exempt names.
    lines = dormant_plan.splitlines()
    by_name = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(user_name#" in line]
    below = [re.sub(r"^[\s:+*()0-9-]*", "", lines[i + 1]).split()[0].split("(")[0] for i in by_name]
    assert sorted(below) == ["HashAggregate"] * 2 + ["WindowGroupLimit"]


def test_kinds_of_activity_are_joined_as_one_table(dormant_plan):
    assert dormant_plan.count("LeftOuter") == 2  # activity by name, attributes by id


def test_age_filter_stays_above_the_choice(dormant_plan):
    choice = dormant_plan.index("row_number()")
    assert 0 < dormant_plan.index("created_date") < choice
    below = dormant_plan[choice:]
    assert not re.search(r"PushedFilters: \[[^\]]*created_date", below)


def test_events_are_reduced_before_their_shuffle(tracker_files, wiki_files):
    frames = {
        "source_name": activity.last_watch(
            tracker_files["userassociation"], tracker_files["app_user"], tracker_files["account"]
        ),
        "primary_resource_id": activity.last_reactivation(
            tracker_files["audit"], tracker_files["app_user"]
        ),
        "assignee": activity.assignee_count(tracker_files["issue"]),
        "lastmodifier": activity.wiki_last_edit(
            wiki_files["content"],
            wiki_files["user_mapping"],
            wiki.wiki_users(wiki_files["account"], wiki_files["directory"]),
        ),
    }
    for key, frame in frames.items():
        plan = plan_of(frame)
        exchange = plan.index(f"Exchange hashpartitioning({key}#")
        assert "HashAggregate(keys=[" + key in plan[exchange:].splitlines()[1], key


def test_aggregates_are_hash_aggregates(dormant_plan):
    assert "SortAggregate" not in dormant_plan and "ObjectHashAggregate" not in dormant_plan


def test_sort_is_left_out_for_the_plan_of_action(tracker_files):
    dormant = dormancy.dormant_accounts(tracker_files, AS_OF)
    names = dormancy.dormant_external(dormant, "@mycompany.example")
    plan = deactivation.deactivation_plan(
        names, tracker_files["account"], tracker_files["directory"]
    )
    assert "rangepartitioning" not in plan_of(plan)


def test_wiki_users_are_cut_down_before_they_meet_their_login_days(wiki_files):
    for strict in (False, True):
        plan = plan_of(wiki.wiki_dormant(wiki_files, AS_OF, strict=strict, ordered=False))
        # In a plan, what is done first stands last.
        days = plan.index("SortMergeJoin [lower_user_name#")
        assert days < plan.index("LeftOuter") < plan.index("LeftAnti")
        assert plan.count("LeftAnti") == 1
        edit = plan[days : plan.index("LeftOuter")].count("lastpagemoddate")
        assert ("Filter" in plan[days : plan.index("LeftOuter")]) == strict, edit


def test_login_rule_has_no_product_or_python(tracker_files):
    plan = plan_of(login_rule.dormant_by_login_rule(tracker_files, AS_OF))
    assert plan.count("WindowGroupLimit") == 4  # accounts by name, login values by account
    assert scans(plan, "attribute_value") == 1 and plan.count("LeftOuter") == 2
    for unwanted in ("CartesianProduct", "NestedLoop", "Python", "SortAggregate"):
        assert unwanted not in plan


def test_only_accounts_of_the_names_asked_for_are_ranked(tracker_files):
    dormant = dormancy.dormant_accounts(tracker_files, AS_OF, ordered=False)
    names = dormancy.dormant_external(dormant, "@mycompany.example")
    plan = plan_of(
        deactivation.deactivation_plan(names, tracker_files["account"], tracker_files["directory"])
    )
    ranked = plan.index("row_number() windowspecdefinition(lower_user_name#")
    assert "LeftSemi" in plan[ranked:]


def test_small_sides_are_broadcast_by_their_size_alone(settings, tracker_files):
    settings(spark__sql__autoBroadcastJoinThreshold="10485760")
    plan = plan_of(dormancy.licensed_accounts(tracker_files))
    assert "BroadcastHashJoin" in plan
    import pathlib

    library = pathlib.Path(dormancy.__file__).parents[1]
    for file in library.rglob("*.py"):
        if "llm" not in file.relative_to(library).parts:
            assert "broadcast(" not in file.read_text(), file


def shuffled_rows(frame) -> list[int]:
    """How many rows each shuffle of a query that has run has written."""
    found = []

    def visit(node):
        metrics = node.metrics()
        if metrics.contains("shuffleRecordsWritten"):
            found.append(metrics.get("shuffleRecordsWritten").get().value())
        kind = node.getClass().getSimpleName()
        inner = [node.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [node.plan()] if kind.endswith("QueryStageExec") else []
        children = node.children()
        for child in [*inner, *(children.apply(i) for i in range(children.size()))]:
            visit(child)

    visit(frame._jdf.queryExecution().executedPlan())
    return found


def test_accounts_not_asked_for_are_not_shuffled(spark, settings, tmp_path):
    threshold = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    settings(**{threshold.replace(".", "__"): "0"})
    spark.range(100_000).selectExpr(
        "id", "1L AS directory_id", "concat('User', id) AS user_name", "lower(concat('User', id)) AS lower_user_name",
        "id % 5 <> 0 AS is_active",
    ).write.parquet(f"{tmp_path}/accounts")
    spark.range(300).selectExpr("if(id % 3 = 0, concat('gone', id), concat('USER', id * 331)) AS user_name").write.parquet(f"{tmp_path}/names")
    accounts, names = spark.read.parquet(f"{tmp_path}/accounts"), spark.read.parquet(f"{tmp_path}/names")
    directories = spark.createDataFrame([(1, True, 0)], "id long, is_active boolean, directory_position int")
    plan = deactivation.deactivation_plan(names, accounts, directories)
    assert "might_contain" in plan_of(plan)
    found = {row.user_name: row.status for row in plan.collect()}
    assert max(shuffled_rows(plan)) < 2_000
    for n in range(300):
        key = f"gone{n}" if n % 3 == 0 else f"USER{n * 331}"
        known = n % 3 != 0 and n * 331 < 100_000
        assert found[key] == ("not_found" if not known else "deactivated" if n * 331 % 5 else "already_inactive"), key
