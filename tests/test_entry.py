import __spark_entry__ as entry
from check import compare
import pytest

from conftest import SMALL
from millrace.queries import QUERIES

SLOW = {"classify_cv", "feature_elimination", "random_search"}


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["brand", "car_name", "cars", "bids"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query_agrees_with_sql(spark, name):
    assert compare(spark, SMALL, name) is None


def test_no_query_joins_all_with_all(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in sorted(set(QUERIES) - SLOW - {n for n in QUERIES if n.startswith("stream_")}):
            plan = entry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
            assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
