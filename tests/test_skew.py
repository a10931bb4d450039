"""A key holding a third of all rows: results stay exact and the plans
split or pre-aggregate the hot group."""

from pyspark.sql import functions as F

from strata.plans import catalog, dirty, gold, jobs, silver
from strata.session import scratch_path
from strata.sources import sinks

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _with_conf(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _hot_orders(spark, sf):
    # several map tasks: AQE splits a skewed partition by map output
    o = dirty.landed(spark, sf, "dirty_orders").repartition(8)
    return o.withColumn("cliente_id", F.when(F.col("_linha") % 3 == 0, F.lit("7")).otherwise(F.col("cliente_id")))


def test_hot_customer_is_split_in_the_registered_queries(spark, monkeypatch):
    """A third of the orders on one customer, through the queries as they are registered."""
    sf = "/root/testdata/sf0.01"
    monkeypatch.setattr(dirty, "dirty_orders", _hot_orders)
    old = _with_conf(spark, SKEW_CONF)
    try:
        for key in ("silver_orders", "fk_filter_semi"):
            df = catalog.QUERIES[key](spark, sf)
            rows = sorted(tuple(r) for r in df.collect())
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString(), key
            spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
            assert rows == sorted(tuple(r) for r in catalog.QUERIES[key](spark, sf).collect())
            spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
            assert sum(7 in r for r in rows) > len(rows) // 4
        # the first exchange above the orders of the revenue mart receives partial aggregates
        plan = catalog.QUERIES["gold_revenue_customer_month"](spark, sf)._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        scan = max(i for i, line in enumerate(lines) if "FileScan parquet" in line and "pedido_id" in line)
        above = [line for line in lines[:scan] if "Exchange" in line or "HashAggregate" in line]
        assert "partial_sum" in above[-1] and "Exchange" in above[-2]
    finally:
        _restore(spark, old)


def test_gold_pre_aggregates_hot_customer(spark):
    sf = "/root/testdata/sf0.01"
    c = sinks.materialize(catalog.s_customers(spark, sf), scratch_path(spark, "skew-c2"))
    o = sinks.materialize(silver.silver_orders(_hot_orders(spark, sf), c, as_of=catalog.AS_OF),
                          scratch_path(spark, "skew-o"))
    g = gold.revenue_customer_month(o, c)
    plan = g._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    # the first exchange above the orders scan receives partial aggregates
    scan = max(i for i, line in enumerate(lines) if "FileScan parquet" in line and "pedido_id" in line)
    above = [line for line in lines[:scan] if "Exchange" in line or "HashAggregate" in line]
    assert "partial_sum" in above[-1] and "Exchange" in above[-2]
    assert g.where("cliente_id = 7").count() > 0


def test_quality_gate_and_marts(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    specs = catalog.landed_raw(spark, sf)
    bronze = scratch_path(spark, "gate-bronze")
    jobs.bronze_ingest(spark, specs, bronze)
    out = scratch_path(spark, "gate-lake")
    import pytest
    with pytest.raises(jobs.QualityGateError):
        jobs.run_profile_s(spark, bronze, out, as_of=catalog.AS_OF, fail_on_error=True)
    built = jobs.run_marts(spark, f"{out}/gold", f"{out}/marts")
    assert set(built) == {"kpis", "faturamento_por_mes", "top_clientes", "faturamento_por_estado",
                          "participacao_metodos", "volume_metodos"}
    assert spark.read.parquet(built["top_clientes"]).count() <= 10
    assert jobs.run_marts(spark, f"{out}/nothing", f"{out}/marts2") == {}


def test_hot_order_in_payment_mart_is_split_and_exact(spark):
    sf = "/root/testdata/sf0.01"
    c = sinks.materialize(catalog.s_customers(spark, sf), scratch_path(spark, "skew-c3"))
    o = sinks.materialize(silver.silver_orders(dirty.dirty_orders(spark, sf), c, as_of=catalog.AS_OF),
                          scratch_path(spark, "skew-o3"))
    hot = o.where("status = 'CONCLUÍDO'").orderBy("pedido_id").first()["pedido_id"]
    pay = dirty.dirty_payments(spark, sf).withColumn(
        "pedido_id", F.when(F.col("_linha") % 3 == 0, F.lit(str(hot))).otherwise(F.col("pedido_id")))
    # several files = several map tasks: AQE splits a skewed partition by map output
    ps = sinks.materialize(silver.silver_payments(pay, o).repartition(8), scratch_path(spark, "skew-p3"))
    old = _with_conf(spark, SKEW_CONF)
    try:
        g = gold.payment_methods_month(ps, o)
        rows = sorted(tuple(r) for r in g.collect())
        assert "skew=true" in g._jdf.queryExecution().executedPlan().toString()
    finally:
        _restore(spark, old)
    # brute force: one row per (payment row, completed order row) pair
    pairs = ps.join(o.where("status = 'CONCLUÍDO'").select("pedido_id"), "pedido_id")
    want = pairs.groupBy(F.date_format("data_pagamento", "yyyy-MM").alias("m"), "metodo_pagamento").agg(
        F.count_distinct("pagamento_id"), F.sum("valor_pago").cast("decimal(38,2)"))
    assert rows == sorted(tuple(r) for r in want.collect())
