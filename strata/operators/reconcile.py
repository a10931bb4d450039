"""Charged-vs-paid reconciliation (DQ7, JN7, PRJ6, FIL6, NUM6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile_join(orders: DataFrame, payments: DataFrame, key: str = "pedido_id",
                   null_safe: bool = False, suffixes=("_pedido", "_pagamento")) -> DataFrame:
    """JN7: inner join, one row per matching (order row, payment row) pair.

    NULL keys do not match (SQL semantics). pandas ``merge`` would pair
    every NULL-key order with every NULL-key payment -- an all-pairs
    product over one group that can hold a large share of the rows -- so
    that behaviour is opt-in (``null_safe=True``) for small, audited inputs.
    Columns present on both sides other than the key get ``suffixes``."""
    shared = (set(orders.columns) & set(payments.columns)) - {key}
    o = orders.select(*[F.col(c).alias(c + suffixes[0] if c in shared else c) for c in orders.columns])
    p = payments.select(*[F.col(c).alias(c + suffixes[1] if c in shared else c) for c in payments.columns])
    p = p.withColumnRenamed(key, "__pk")
    cond = o[key].eqNullSafe(p["__pk"]) if null_safe else (o[key] == p["__pk"])
    return o.join(p, cond, "inner").drop("__pk")


def divergences(orders: DataFrame, payments: DataFrame, tolerance: float = 0.01,
                per_order: bool = False, key: str = "pedido_id", null_safe: bool = False) -> DataFrame:
    """DQ7: rows where charged - paid differs by more than ``tolerance``.

    ``per_order=False`` compares each joined pair (the reference);
    ``per_order=True`` sums the payments of an order first (map-side
    partial aggregation), which is what a finance check usually wants."""
    if per_order:
        payments = payments.groupBy(key).agg(F.sum("valor_pago").alias("valor_pago"))
    j = reconcile_join(orders.select(key, "valor_total"), payments.select(key, "valor_pago"), key, null_safe)
    j = j.withColumn("diferenca", F.col("valor_total") - F.col("valor_pago"))
    return j.where(F.abs(F.col("diferenca")) > F.lit(tolerance)).select(key, "valor_total", "valor_pago", "diferenca")
