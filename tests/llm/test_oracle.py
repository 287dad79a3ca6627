"""Every query on text that SQL can express, against its SQL over whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from dormouse.llm.queries import ORACLE_SQL, QUERIES
from sample.check import connect

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    with connect(SF_DIR) as connection:
        expected = connection.execute(ORACLE_SQL[name])
        columns = [c[0] for c in expected.description]
        wanted = sorted(expected.fetchall(), key=repr)
    found = QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == sorted(columns)
    assert sorted((tuple(r) for r in found.select(*columns).collect()), key=repr) == wanted


def test_all_operators_are_registered():
    names = set(entry.queries())
    assert set(QUERIES) <= names and "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
