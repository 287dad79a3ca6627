"""Layouts that later reads profit from."""

from __future__ import annotations

from pyspark.sql import functions as F

from dormouse.operators import activity
from dormouse.sources.writers import read_in_order, write_by_value, write_in_order
from tests.build import account, files_read, last_login, millis, tracker


def test_equal_filters_open_one_folder(spark, tmp_path, tracker_files):
    items = write_by_value(tracker_files["changeitem"], str(tmp_path / "items"), "field", "groupid")
    assigned = items.filter("field = 'assignee'")
    assert "PartitionFilters: [isnotnull(field" in assigned._jdf.queryExecution().executedPlan().toString()
    assert all("field=assignee" in f for f in files_read(assigned)) and len(files_read(assigned)) < len(files_read(items))
    found = activity.last_assignment(tracker_files["changegroup"], items)
    wanted = activity.last_assignment(tracker_files["changegroup"], tracker_files["changeitem"])
    assert found.exceptAll(wanted).count() == wanted.exceptAll(found).count() == 0 and wanted.count() > 0


def test_attributes_by_name_give_the_same_logins(spark, tmp_path, tracker_files):
    attrs = write_by_value(tracker_files["attrs"], str(tmp_path / "attrs"), "attribute_name", "user_id")
    assert attrs.schema == tracker_files["attrs"].schema
    found, wanted = activity.login_stats(attrs), activity.login_stats(tracker_files["attrs"])
    assert found.exceptAll(wanted).count() == wanted.exceptAll(found).count() == 0
    read = files_read(attrs.filter(F.col("attribute_name").isin("lastAuthenticated")))
    assert read and all("attribute_name=lastAuthenticated" in f for f in read)


def test_files_of_a_hot_value_have_ranges_of_the_key(spark, tmp_path, settings):
    settings(spark__sql__shuffle__partitions="8", spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = spark.range(4000).selectExpr("if(id % 3 = 0, 'hot', concat('v', id % 4)) AS field", "id AS groupid")
    items = write_by_value(rows, str(tmp_path / "items"), "field", "groupid")
    hot = items.filter("field = 'hot'").groupBy(F.input_file_name().alias("f")).agg(F.min("groupid").alias("a"), F.max("groupid").alias("b"))
    ranges = sorted((r.a, r.b) for r in hot.collect())
    assert len(ranges) > 1 and all(one[1] < two[0] for one, two in zip(ranges, ranges[1:]))


def test_order_is_kept_in_files(spark, tmp_path):
    rows = spark.range(5000).selectExpr(
        "concat('u', id) AS user_name", "if(id % 7 = 0, NULL, date_format(date_add(DATE'2020-01-01', cast(id * 37 % 900 as int)), 'yyyy-MM-dd')) AS lastlogin"
    )
    order = [F.desc_nulls_last("lastlogin"), F.col("user_name")]
    write_in_order(rows.repartition(6), str(tmp_path / "list"), *order, slices=5)
    back = read_in_order(spark, str(tmp_path / "list"), rows.schema)
    assert len(back.inputFiles()) > 2
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan
    assert back.collect() == rows.orderBy(*order).collect()


def test_order_of_few_and_no_rows(spark, tmp_path):
    ann = account(1, "ann")
    attrs = tracker(spark, attrs=[last_login(ann, millis("2024-01-01"))])["attrs"]
    write_in_order(attrs, str(tmp_path / "one"), "user_id")
    assert read_in_order(spark, str(tmp_path / "one"), attrs.schema).count() == 1
    write_in_order(attrs.filter("false"), str(tmp_path / "none"), "user_id")
    assert read_in_order(spark, str(tmp_path / "none"), attrs.schema).count() == 0
