from __future__ import annotations

import pytest

from dormouse.jobs import main, parser
from dormouse.operators import quarantine
from dormouse.plans.account_store import stored_accounts
from dormouse.plans.deactivation import deactivation_summary, observed, observed_summary
from dormouse.plans.dormancy import dormant_accounts, dormant_external, licensed_accounts
from dormouse.plans.views import publish_views
from dormouse.session import apply_settings, planned_bytes
from dormouse.sources.schemas import SOURCE_NAMES, TRACKER, WIKI
from dormouse.sources.tables import from_catalog, from_parquet
from sample.tables import DERIVATIONS, Sample
from tests.build import account, last_login, member, millis, tracker
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def database(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("database"))
    sample = Sample(spark, SMALL)
    for name in TRACKER:
        DERIVATIONS[name](sample).write.parquet(f"{root}/{SOURCE_NAMES[name]}")
    return root


def status_counts(spark, path):
    return {row.status: row["count"] for row in spark.read.parquet(path).groupBy("status").count().collect()}


def test_dry_run_writes_only_the_plan(spark, database, tmp_path, capsys):
    out = tmp_path / "run"
    main(["--parquet", database, "--out", str(out), "--as-of", "2001-08-02",
          "--email-suffix", "@mycompany.example"])
    assert status_counts(spark, f"{out}/plan") == {"deactivated": 36, "already_inactive": 1}
    assert not (out / "cwd_user").exists()
    assert "36 inactive users automatically deactivated." in capsys.readouterr().out


def test_applied_run_switches_off_what_the_plan_says(spark, database, tmp_path):
    out = tmp_path / "run"
    main(["--parquet", database, "--out", str(out), "--as-of", "2001-08-02", "--rule", "login",
          "--apply"])
    done = status_counts(spark, f"{out}/plan")["deactivated"]
    before = spark.read.parquet(f"{database}/cwd_user").filter("active = 1").count()
    after = spark.read.parquet(f"{out}/cwd_user")
    assert after.schema == spark.read.parquet(f"{database}/cwd_user").schema
    assert {"external_id", "credential"} <= set(after.columns)
    assert after.count() == 187
    assert after.filter("active = 1").count() == before - done and done > 0
    again = from_parquet(spark, str(out), TRACKER)["account"]
    assert again.filter("is_active").count() == before - done


def test_reports(spark, database, tmp_path):
    main(["--parquet", database, "--out", f"{tmp_path}/paid", "--rule", "licences"])
    assert spark.read.parquet(f"{tmp_path}/paid/report").count() > 0
    root = str(tmp_path / "wiki")
    sample = Sample(spark, SMALL)
    for name in WIKI:
        DERIVATIONS[name](sample).write.parquet(f"{root}/{SOURCE_NAMES[name]}")
    main(["--parquet", root, "--out", f"{tmp_path}/idle", "--rule", "wiki", "--as-of", "2001-08-02"])
    assert spark.read.parquet(f"{tmp_path}/idle/report").columns[0] == "mention"


def test_live_database_options():
    found = parser().parse_args([
        "--jdbc", "jdbc:x", "--out", "o", "--rule", "login", "--small", "directory",
        "--split", "account=id,0,1000,4",
        "--split", "changegroup=created,2020-01-01T00:00:00,2024-01-01T00:00:00,8",
        "--property", "user=me",
    ])
    splits = dict(found.split)
    assert (splits["account"].upper, splits["account"].partitions) == (1000, 4)
    assert splits["changegroup"].lower.year == 2020 and splits["changegroup"].upper.year == 2024
    assert found.small == ["directory"] and found.property == [("user", "me")]


def test_stored_views_equal_the_plans(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS stored_db")
    sample = Sample(spark, SMALL)
    for name in TRACKER:
        DERIVATIONS[name](sample).write.mode("overwrite").saveAsTable(f"stored_db.`{SOURCE_NAMES[name]}`")
    main(["--database", "stored_db", "--store-views", "--email-suffix", "@mycompany.example"])
    tables = from_catalog(spark, "stored_db", TRACKER)
    dormant = dormant_accounts(tables, ordered=False)
    for view, wanted in {
        "active_users": licensed_accounts(tables),
        "inactive_users_all": dormant,
        "inactive_users": dormant_external(dormant, "@mycompany.example"),
    }.items():
        found = spark.table(f"stored_db.{view}")
        assert found.columns == wanted.columns
        assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect())), view
        assert found.count() > 0


@pytest.mark.parametrize(("as_of", "months", "group"), [
    ("2001-08-02 00:00:00", 3, "never-deactivate"), ("2001-05-31 06:00:00", 3, "all-staff"), ("2000-02-29 12:00:00", 12, "no such group"),
])
def test_table_functions_equal_the_plans(spark, as_of, months, group):
    tables = from_catalog(spark, "stored_db", TRACKER)
    dormant = dormant_accounts(tables, as_of, months, group, ordered=False)
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase("stored_db")
    try:
        all_at = spark.sql(f"SELECT * FROM inactive_users_all_at(TIMESTAMP'{as_of}', {months}, '{group}')")
        some_at = spark.sql(
            f"SELECT * FROM inactive_users_at('@mycompany.example', TIMESTAMP'{as_of}', months => {months}, exempt_group => '{group}')"
        )
        now = spark.sql("SELECT * FROM inactive_users_at()")
        for found, wanted in ((all_at, dormant), (some_at, dormant_external(dormant, "@mycompany.example")),
                              (now, spark.table("inactive_users"))):
            assert found.columns == wanted.columns and wanted.count() > 0
            assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect()))
        plan = all_at._jdf.queryExecution().optimizedPlan().toString()
        assert f"= {group})" in plan and "outer(" not in plan
    finally:
        spark.catalog.setCurrentDatabase(before)


def test_shuffle_partitions_follow_planned_sizes(spark, database, settings):
    settings(spark__sql__shuffle__partitions="8")
    size = planned_bytes(from_parquet(spark, database, TRACKER)[name] for name in ("audit", "issue"))
    assert 0 < size < 1 << 30
    apply_settings(spark, 9 * 256 * 1024 * 1024)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "9"
    apply_settings(spark, size)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "9"


def test_another_time_zone_is_refused(spark, settings):
    ann = account(1, "ann")
    tables = tracker(spark, account=[ann], membership=[member(ann)])
    settings(spark__sql__session__timeZone="America/New_York")
    with pytest.raises(ValueError, match="New_York"):
        publish_views(tables, "@mycompany.example")


def test_second_run_to_the_same_place_fails(database, tmp_path):
    arguments = ["--parquet", database, "--out", str(tmp_path / "run"), "--rule", "login"]
    main(arguments)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        main(arguments)


def test_activity_rule_needs_the_address_suffix(database, tmp_path, capsys):
    with pytest.raises(SystemExit):
        main(["--parquet", database, "--out", str(tmp_path / "run")])
    assert "--email-suffix" in capsys.readouterr().err


def test_views_answer_sql(spark):
    ann, bob = account(1, "ann"), account(2, "bob", email="bob@mycompany.example")
    tables = tracker(
        spark,
        account=[ann, bob],
        membership=[member(ann), member(bob)],
        license=[dict(license_role_name="jira-software", group_id="staff")],
        attrs=[last_login(ann, millis("2020-01-01"))],
    )
    publish_views(tables, "@mycompany.example")
    assert spark.sql("SELECT user_name FROM active_users ORDER BY 1").collect() == [("ann",), ("bob",)]
    assert spark.sql("SELECT user_name, lastlogin FROM inactive_users_all").collect() == [
        ("ann", "2020-01-01"), ("bob", None)
    ]
    assert spark.sql("SELECT * FROM inactive_users").count() == 1


def test_views_without_an_instant_look_at_the_clock_of_each_read(spark):
    ann = account(1, "ann")
    tables = tracker(spark, account=[ann], membership=[member(ann)])
    publish_views(tables, "@mycompany.example")
    plan = spark.table("inactive_users_all")._jdf.queryExecution().analyzed().toString()
    assert "current_timestamp()" in plan


def test_daily_runs_from_what_earlier_ones_kept(spark, database, tmp_path, capsys):
    common = ["--parquet", database, "--email-suffix", "@mycompany.example"]
    index, state, store = (str(tmp_path / name) for name in ("index", "state", "store"))
    main([*common, "--out", f"{tmp_path}/one", "--as-of", "2001-08-02", "--apply", "--quarantine",
          "--expiry-index", index, "--activity-state", state, "--account-store", store])
    assert status_counts(spark, f"{tmp_path}/one/plan") == {"deactivated": 36, "already_inactive": 1}
    assert "36 inactive users automatically deactivated." in capsys.readouterr().out
    assert not (tmp_path / "one" / "cwd_user").exists()
    before = spark.read.parquet(f"{database}/cwd_user")
    after = stored_accounts(spark, store)
    assert after.columns == before.columns
    assert after.filter("active = 1").count() == before.filter("active = 1").count() - 36
    assert quarantine.rejected_rows(spark, f"{tmp_path}/one/cwd_user_attributes").count() > 0
    main([*common, "--out", f"{tmp_path}/two", "--as-of", "2001-08-02", "--since", "2001-05-31 06:00:00",
          "--expiry-index", index])
    new = {r.user_name for r in spark.read.parquet(f"{tmp_path}/two/names").collect()}
    old = from_parquet(spark, database, TRACKER)
    listed = [
        {r.user_name for r in dormant_external(dormant_accounts(old, moment), "@mycompany.example").collect()}
        for moment in ("2001-05-31 06:00:00", "2001-08-02")
    ]
    assert new == listed[1] - listed[0] and new


def test_summary_is_counted_while_the_plan_is_written(spark, tmp_path):
    rows = [("a", "deactivated"), ("b", "deactivated"), ("c", "not_found")]
    plan = spark.createDataFrame(rows, "user_name string, status string")
    watched, counts = observed(plan)
    watched.write.parquet(f"{tmp_path}/plan")
    found, wanted = observed_summary(spark, counts), deactivation_summary(plan)
    assert found.columns == wanted.columns and sorted(found.collect()) == sorted(wanted.collect())
    watched, counts = observed(plan.filter("false"))
    watched.write.parquet(f"{tmp_path}/none")
    assert observed_summary(spark, counts).count() == 0


def test_since_needs_an_index(database, tmp_path, capsys):
    with pytest.raises(SystemExit):
        main(["--parquet", database, "--out", str(tmp_path / "run"), "--email-suffix", "@x", "--since", "2001-01-01"])
    assert "--expiry-index" in capsys.readouterr().err
