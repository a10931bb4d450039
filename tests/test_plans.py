"""Plan-shape checks: the properties that matter at scale."""

import pytest

import __spark_entry__ as E


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def qs():
    return E.queries()


@pytest.mark.parametrize("name", ["silver_customers", "silver_orders", "silver_payments",
                                  "gold_revenue_customer_month", "gold_payment_methods", "dq_report",
                                  "audit_report", "reconcile_divergence", "gold_revenue_lenient",
                                  "mart_method_share", "mart_top_customers"])
def test_no_python_and_no_single_partition(spark, sf_small, qs, name):
    p = _plan(qs[name](spark, sf_small))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in p, (name, bad)
    # A single-partition exchange is only allowed on top of partial
    # aggregates (one row per map task) -- never over raw rows.
    lines = p.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            child = lines[i + 1] if i + 1 < len(lines) else ""
            assert "partial_" in child or "functions=[]" not in child and "HashAggregate" in child, (name, child)


def test_dedup_uses_partial_window_group_limit(spark, sf_small, qs):
    p = _plan(qs["dedup_best_row"](spark, sf_small))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_filters_reach_parquet_scan(spark, tmp_path):
    spark.createDataFrame([(1, "CONCLUÍDO", 1.0), (2, "PENDENTE", 2.0)], "pedido_id long, status string, v double") \
        .write.parquet(str(tmp_path / "o"))
    from pyspark.sql import functions as F
    df = spark.read.parquet(str(tmp_path / "o")).where(F.col("status") == "CONCLUÍDO").select("pedido_id")
    s = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,CONCLUÍDO)]" in s
    assert "ReadSchema: struct<pedido_id:bigint,status:string>" in s


def test_share_uses_scalar_subquery(spark, sf_small, qs):
    p = _plan(qs["mart_method_share"](spark, sf_small))
    assert "Subquery" in p
