from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from dormouse.functions.time import instant, months_before
from dormouse.operators.activity import last_assignment
from dormouse.session import apply_settings
from dormouse.sources.schemas import SOURCE_NAMES, TRACKER, WIKI
from dormouse.sources.tables import Split, Tables, conform, from_catalog, from_jdbc, from_parquet
from dormouse.sources.writers import write_table
from sample.tables import DERIVATIONS, Sample
from tests.conftest import SMALL


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="'issue' lacks columns \\['assignee'\\]"):
        conform("issue", spark.range(1), TRACKER["issue"])


def test_tables_are_opened_once_and_only_when_used(spark):
    opened = []

    def open_table(name):
        opened.append(name)
        return spark.createDataFrame([("ann",)], "assignee string")

    tables = Tables(TRACKER, open_table)
    assert not opened and len(tables) == len(list(tables)) == 13
    assert tables["issue"] is tables["issue"] and opened == ["issue"]
    with pytest.raises(KeyError):
        tables["nothing"]


@pytest.mark.parametrize(
    ("kind", "values"),
    [("int", [1, 0, None]), ("bigint", [1, 0, None]), ("string", ["T", "F", None]),
     ("boolean", [True, False, None])],
)
def test_flags(spark, kind, values):
    table = spark.createDataFrame(
        [(n, value, n) for n, value in enumerate(values)],
        f"id bigint, active {kind}, directory_position int",
    )
    found = conform("directory", table, TRACKER["directory"]).orderBy("id").collect()
    assert [row.is_active for row in found] == [True, False, None]


def test_wiki_names_for_columns(spark):
    table = spark.createDataFrame([(1, 2)], "child_user_id bigint, parent_id bigint")
    assert conform("membership", table, WIKI["membership"]).columns == ["child_id", "parent_id"]
    groups = spark.createDataFrame([(1, "Staff")], "id bigint, group_name string")
    assert conform("grp", groups, WIKI["grp"]).collect() == [(1, "Staff", "staff")]


def test_upper_case_columns_and_plain_timestamps(spark):
    audit = spark.createDataFrame(
        [(5, "K", "USER", "x")],
        "ENTITY_TIMESTAMP bigint, PRIMARY_RESOURCE_ID string, PRIMARY_RESOURCE_TYPE string, "
        "CHANGE_VALUES string",
    )
    assert conform("audit", audit, TRACKER["audit"]).columns == TRACKER["audit"].fieldNames()
    plain = spark.sql("SELECT 1L AS id, TIMESTAMP_NTZ'2020-01-01 12:00:00' AS created")
    found = conform("changegroup", plain, TRACKER["changegroup"])
    assert found.select(F.unix_seconds("created")).collect() == [(1577880000,)]


def test_every_table_opens_from_files_under_its_source_name(spark, tmp_path):
    sample = Sample(spark, SMALL)
    for name in ("issue", "audit"):
        DERIVATIONS[name](sample).write.parquet(f"{tmp_path}/{SOURCE_NAMES[name]}")
    tables = from_parquet(spark, str(tmp_path), TRACKER)
    assert tables["issue"].count() == tables["audit"].count() == 1500


def test_catalog_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS tracker_db")
    DERIVATIONS["audit"](Sample(spark, SMALL)).write.saveAsTable(
        f"tracker_db.{SOURCE_NAMES['audit']}"
    )
    assert from_catalog(spark, "tracker_db", TRACKER)["audit"].count() == 1500


def test_changes_bucketed_by_their_group_are_joined_without_a_shuffle(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    spark.sql("CREATE DATABASE IF NOT EXISTS bucket_db")
    sample = Sample(spark, SMALL)
    for name, key in (("changegroup", "id"), ("changeitem", "groupid")):
        rows = DERIVATIONS[name](sample)
        rows.write.mode("overwrite").bucketBy(4, key).sortBy(key).saveAsTable(f"bucket_db.{SOURCE_NAMES[name]}")
    tables = from_catalog(spark, "bucket_db", TRACKER)
    found = last_assignment(tables["changegroup"], tables["changeitem"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    joined = plan[plan.index("SortMergeJoin") :]
    assert "Exchange" not in joined
    plain = Sample(spark, SMALL)
    wanted = last_assignment(*(
        conform(name, DERIVATIONS[name](plain), TRACKER[name]) for name in ("changegroup", "changeitem")
    ))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


def test_jdbc_options():
    given = {}

    class Reader:
        def format(self, name):
            given["format"] = name
            return self

        def option(self, key, value):
            given[key] = value
            return self

        def options(self, **values):
            given.update(values)
            return self

        def load(self):
            raise StopIteration

    class Session:
        read = Reader()

    tables = from_jdbc(
        Session(), "jdbc:postgresql://db/tracker", TRACKER,
        {"audit": Split("ID", 0, 1000, 20)}, {"fetchsize": "10000"},
    )
    with pytest.raises(StopIteration):
        tables["audit"]
    assert given == {
        "format": "jdbc",
        "url": "jdbc:postgresql://db/tracker",
        "dbtable": '"AO_C77861_AUDIT_ENTITY"',
        "fetchsize": "10000",
        "partitionColumn": "ID",
        "lowerBound": "0",
        "upperBound": "1000",
        "numPartitions": "20",
    }


def test_database_table_needs_a_split_or_a_mark():
    tables = from_jdbc(None, "jdbc:x", TRACKER, {})
    with pytest.raises(ValueError, match="'issue' needs a split"):
        tables["issue"]


def test_writing_does_not_replace(spark, tmp_path):
    path = f"{tmp_path}/out"
    assert write_table(spark.range(3), path).count() == 3
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_table(spark.range(3), path)


def test_partition_sizes_follow_the_data(spark, settings):
    settings(spark__sql__shuffle__partitions="8", spark__sql__files__maxPartitionBytes="128MB")
    gib, tib = 1024**3, 1024**4
    apply_settings(spark, shuffle_bytes=10 * tib, input_bytes=100 * tib)
    assert spark.conf.get("spark.sql.shuffle.partitions") == str(40 * 1024)
    assert int(spark.conf.get("spark.sql.files.maxPartitionBytes")) == 1 * gib
    settings(spark__sql__shuffle__partitions="8")
    apply_settings(spark, shuffle_bytes=1, input_bytes=gib)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert int(spark.conf.get("spark.sql.files.maxPartitionBytes")) == gib // 8


def test_instants(spark):
    from datetime import datetime, timedelta, timezone

    east = timezone(timedelta(hours=2))
    frame = spark.range(1).select(
        *[
            F.unix_seconds(instant(moment)).alias(name)
            for name, moment in {
                "text": "2020-01-01 12:00:00",
                "naive": datetime(2020, 1, 1, 12),
                "aware": datetime(2020, 1, 1, 14, tzinfo=east),
                "column": F.timestamp_seconds(F.lit(1577880000)),
            }.items()
        ]
    )
    assert frame.collect() == [(1577880000,) * 4]
    now = spark.range(1).select(instant() == F.current_timestamp()).collect()
    assert now == [(True,)]


def test_months_are_clamped(spark):
    cut = spark.range(1).select(F.date_format(months_before("2024-05-31", 3), "yyyy-MM-dd"))
    assert cut.collect() == [("2024-02-29",)]
