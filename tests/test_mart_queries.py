"""Plans of the queries on the mart."""

import pytest

import __spark_entry__  # noqa: F401  registers all queries
from tidegate.sources import outbound
from workload.registry import QUERIES


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A few orders and customers."""
    root = tmp_path_factory.mktemp("tables")
    spark.range(40).selectExpr(
        "id AS o_orderkey", "id % 10 AS o_custkey", "'F' AS o_orderstatus", "cast(1000 * id AS double) AS o_totalprice",
        "timestamp_ntz'2001-01-05 00:00:00' + make_interval(0, 3 * cast(id % 2 AS int)) AS o_orderdate",
        "'1-URGENT' AS o_orderpriority",
    ).write.parquet(f"{root}/orders.parquet")
    spark.range(10).selectExpr(
        "id AS c_custkey", "concat('n', id) AS c_name", "cast(id % 25 AS int) AS c_nationkey", "'BUILDING' AS c_mktsegment"
    ).write.parquet(f"{root}/customer.parquet")
    return str(root)


@pytest.mark.parametrize("name", [
    "mart_audit", "mart_constraints", "named_checks", "ordered_reasons", "reason_patterns", "report_keys", "review_flags",
    "mart_summary",
])
def test_queries_on_the_mart_merge_clients(spark, tables, name):
    """Not one of them sends the clients, which unfold by quarter, through the driver."""
    plan = QUERIES[name](spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [business_date" in plan
    assert all("client_id" not in line for line in plan.splitlines() if "BroadcastHashJoin" in line)


def test_report_files_merge_clients(spark, tables, monkeypatch):
    """Neither the mart nor the report that is exported sends them through the driver."""
    plans, publish = [], outbound.publish

    def publish_seen(report, folder, stored):
        plans.append(report._jdf.queryExecution().executedPlan().toString())
        return publish(report, folder, stored)

    monkeypatch.setattr(outbound, "publish", publish_seen)
    assert QUERIES["report_files"](spark, tables).count() > 0
    (plan,) = plans
    assert plan.count("SortMergeJoin [business_date") == 2
    assert all("client_id" not in line for line in plan.splitlines() if "BroadcastHashJoin" in line)
