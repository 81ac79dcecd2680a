"""Plans and contexts (one per row of part) are joined without a broadcast, whatever their files' sizes say."""

import pytest

from tablelens.plans.suite_diagnose import QUERIES


def _broadcast_files(node, inside=False):
    name, found = node.nodeName(), []
    if name.startswith("Scan parquet") and inside:
        found.append(node.toString())
    inside = inside or name == "BroadcastExchange"
    if name == "AdaptiveSparkPlan":
        return _broadcast_files(node.initialPlan(), inside)
    for i in range(node.children().size()):
        found += _broadcast_files(node.children().apply(i), inside)
    return found


@pytest.mark.parametrize("query", ["replan_steps", "replan_flags"])
def test_plans_of_all_runs_are_not_broadcast(spark, tmp_path, query):
    spark.range(1, 40).selectExpr("id AS p_partkey", "cast(id % 50 AS int) AS p_size").write.parquet(f"{tmp_path}/part.parquet")
    lines = "id AS l_orderkey, id % 45 AS l_partkey, 1 + id % 40 AS l_suppkey, cast(1 + id % 7 AS int) AS l_linenumber, 'R' AS l_returnflag"
    spark.range(2000).selectExpr(*lines.split(", ")).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = QUERIES[query](spark, str(tmp_path))
    assert not [f for f in _broadcast_files(got._jdf.queryExecution().executedPlan()) if "p_partkey" in f]
    assert got.select("run_id").distinct().count() >= 39
