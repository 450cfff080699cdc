"""Plan shape: no cartesian or nested-loop joins, no Python UDFs, top-k as a
partial WindowGroupLimit, scans pruned to the used columns."""

import re

import pytest

from tallyloom.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
# driver columns no operator uses: a scan that reads them is not pruned
NEVER_READ = ("o_totalprice", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_retailprice",
              "n_chars", "user_id", "event_type", "props")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")


def plan_of(spark, df, mode="formatted"):
    return spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_forbidden_operators(spark, name):
    plan = plan_of(spark, QUERIES[name](spark, SF))
    bad = [op for op in FORBIDDEN if op in plan]
    assert not bad, f"{name}: {bad}"
    scanned = " ".join(re.findall(r"ReadSchema: [^\n]*", plan))
    unpruned = [c for c in NEVER_READ if re.search(rf"\b{c}:", scanned)]
    assert not unpruned, f"{name} reads unused columns {unpruned}"


def test_topk_uses_window_group_limit(spark):
    plan = plan_of(spark, QUERIES["list_open_plans"](spark, SF))
    assert plan.count("WindowGroupLimit") >= 2  # partial (before the shuffle) and final


def test_scans_are_pruned_and_filtered(spark):
    plan = plan_of(spark, QUERIES["list_open_plans"](spark, SF))
    assert "o_totalprice" not in plan  # column pruning reaches the scan
    plan = plan_of(spark, QUERIES["linked_pr"](spark, SF))
    assert "l_quantity" not in plan and "l_extendedprice" not in plan


@pytest.mark.parametrize("name", ["learn_context", "learn_prompt", "linked_pr", "batch_summary"])
def test_no_text_is_broadcast(spark, name):
    plan = plan_of(spark, QUERIES[name](spark, SF))
    for part in re.findall(r"BroadcastExchange\nInput[^\n]*", plan):
        assert not re.search(r"\b(diff|body|content|text|pr_body|issue_body)#", part), part


def subtrees(plan, root):
    """The lines below each node of a plan tree whose line contains ``root``."""
    rows = [(len(re.match(r"[\s:+|*()\d-]*", x).group()), x) for x in plan.splitlines() if x.strip()]
    for i, (depth, line) in enumerate(rows):
        if root in line:
            below = []
            for d, x in rows[i + 1:]:
                if d <= depth:
                    break
                below.append(x)
            yield below


@pytest.mark.parametrize("name", ["batch_summary", "issue_list_text", "learn_context", "learn_context_rejects", "learn_prompt",
                                  "linked_pr"])
def test_generated_rows_are_not_broadcast(spark, name):
    """Estimates leave out how many rows a generator makes of one: with Spark's own threshold, its rows go by a shuffle."""
    key, was = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "10MB")
    try:
        plan = plan_of(spark, QUERIES[name](spark, SF), "simple")
    finally:
        spark.conf.set(key, was)
    assert "Generate explode" in plan
    assert not [x for below in subtrees(plan, "BroadcastExchange") for x in below if "Generate explode" in x and "r0" in x]


def test_generated_pull_requests_are_spread(spark, tmp_path):
    """Tasks go by the pull requests they make, not by the bytes of the narrow rows they make them of."""
    from pyspark.sql import functions as F

    from tallyloom.sources import fixtures as fx

    n = 60_000
    spark.range(n).coalesce(1).select(
        F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("b").alias("p_brand"), F.lit("t").alias("p_type"),
        F.lit(3).alias("p_size")).write.parquet(str(tmp_path / "part.parquet"))
    prs = fx.pull_requests(spark, str(tmp_path))
    made = prs.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in made) == n * len(fx.REPOS) and max(r["count"] for r in made) < 1.1 * fx.PRS_A_TASK
