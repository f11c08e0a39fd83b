"""Every query against its SQL."""

from __future__ import annotations

import pytest
from compare import connect, differences

from __spark_entry__ import entry
from checks.oracle import ORACLE
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, FOLDER), connection, ORACLE[name]) == []


def test_comparison_notices_a_difference(spark, connection):
    sql = ORACLE["class_distribution"]
    df = QUERIES["class_distribution"](spark, FOLDER)
    assert differences(df, connection, sql.replace("count(*) AS", "count(*) + 1 AS"))
    assert differences(df, connection, sql.replace("count(*) AS", "count(*)::INTEGER AS"))


def test_entry_gives_the_class_distribution(spark):
    assert {row.label_binary for row in entry(spark).collect()} == {0, 1}
