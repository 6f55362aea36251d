"""Queries against their oracle SQL at the smallest scale, and results under other settings."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tools.check import TABLES, digest

FAST = [
    "revenue_by_month", "top10_sellers_each_year", "logistics_order_processing_time",
    "mkt_peak_purchase_times_analysis", "churn_features", "churn_features_dedup",
    "cf_interaction_table", "product_content_features", "customer_content_features",
    "satisfaction_labels", "dq_report", "scd2_merge", "gold_star", "gold_facts", "gold_round_trip", "event_sessions",
    "event_windows_sliding", "slope_one", "knn_items", "json_requests", "summarise_reviews",
    "sequence_tokens", "impute_median",
]


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    return con


def _spark_digest(spark, name):
    df = entry.queries()[name](spark, SMALL)
    return digest(df.columns, [tuple(r) for r in df.collect()])[:3]


@pytest.mark.parametrize("name", FAST)
def test_oracle(spark, oracle, name):
    rel = oracle.execute(entry.oracle_sql()[name])
    want = digest([d[0] for d in rel.description], rel.fetchall())[:3]
    assert _spark_digest(spark, name) == want


@pytest.mark.parametrize("name", ["churn_features", "cf_user_features", "customer_content_features"])
def test_partitioning_does_not_matter(spark, name):
    seen = set()
    for n in ("1", "2", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.add(str(_spark_digest(spark, name)))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(seen) == 1


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_plans_have_no_cartesian_products(spark):
    for name in ("churn_features", "cf_interaction_table", "customer_content_features", "slope_one"):
        plan = entry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "BatchEvalPython" not in plan, name


def test_entry(spark):
    assert entry.entry(spark).count() > 0
