from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from dormouse.llm import sharding
from dormouse.llm.spread import prefix_sums
from tests.llm.plain import odd_rows, table


def check(rows, shards, total_rows):
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append((r.slot, r.doc_id, r.size))
    assert sum(map(len, by_shard.values())) == total_rows
    total, largest = sum(r.size for r in rows), max((r.size for r in rows), default=0)
    for own in by_shard.values():
        assert sorted(s for s, _, _ in own) == list(range(len(own)))
        assert abs(sum(size for _, _, size in own) - total / shards) <= largest
    in_order = [key for shard in sorted(by_shard) for _, key, _ in sorted(by_shard[shard], key=lambda x: x[0])]
    assert in_order == sorted(in_order, key=lambda k: (k is not None, k or 0))


@pytest.mark.parametrize("shards", [1, 4, 40])
def test_shards_are_contiguous_and_balanced(spark, shards):
    rows = spark.range(3000).selectExpr("id % 1999 AS doc_id", "(id * 7919) % 900 + 16 AS size")
    found = sharding.balanced_shards(rows, "size", ["doc_id", "size"], shards).collect()
    check(found, shards, 3000)


def test_one_key_with_a_third_of_all_rows(spark):
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 5, id) AS doc_id", "20L AS size")
    check(sharding.balanced_shards(rows, "size", ["doc_id"], 10).collect(), 10, 3000)


def test_odd_rows(spark, tmp_path):
    docs = table(spark, tmp_path, odd_rows(), extra=True)
    rows = docs.withColumn("size", sharding.byte_size(F.col("text")))
    found = sharding.balanced_shards(rows, "size", ["doc_id"], 3)
    assert found.columns == [*rows.columns, "shard", "slot"]
    got = found.collect()
    assert {r.size for r in got if r.text is None} == {16}
    check(got, 3, len(odd_rows()))
    assert sharding.balanced_shards(rows.where("false"), "size", ["doc_id"], 3).count() == 0
    empty = rows.withColumn("size", F.lit(None).cast("long"))
    assert {r.shard for r in sharding.balanced_shards(empty, "size", ["doc_id"], 3).collect()} == {0}


def test_prefix_sums(spark):
    rows = spark.range(500).selectExpr("(id * 37) % 500 AS k", "id % 7 AS v")
    found = {r.k: r.before for r in prefix_sums(rows, ["k"], {"before": F.col("v")}).collect()}
    values = {(i * 37) % 500: i % 7 for i in range(500)}
    total = 0
    for k in range(500):
        assert found[k] == total
        total += values[k]


def test_written_shards(spark, tmp_path):
    docs = table(spark, tmp_path / "in", [(i, "x" * i) for i in range(200)])
    rows = docs.select("doc_id", sharding.byte_size(F.col("text")).alias("size"))
    sharding.write_shards(docs, sharding.balanced_shards(rows, "size", ["doc_id"], 5), ["doc_id"], f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 200 and back.select("shard").distinct().count() == 5


def test_plan_is_free_of_python(spark):
    rows = spark.range(100).selectExpr("id AS doc_id", "id AS size")
    plan = sharding.balanced_shards(rows, "size", ["doc_id"], 4)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
