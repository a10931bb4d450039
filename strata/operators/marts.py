"""Reporting marts over the gold tables (TR9, TR10; AG4-AG10, SRT1-3).

The marts are small aggregates of gold; each is one partial + final hash
aggregation. Shares use a scalar subquery for the grand total instead of
an unpartitioned window (which would force a single partition) or a
cross join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import fmt_brl_display, fmt_int_display, fmt_pct_display

MONTH_ALIASES = ("mes_ano", "mes")
NAME_ALIASES = ("nome_cliente", "nome")
REVENUE_ALIASES = ("faturamento_total",)
ORDERS_ALIASES = ("total_pedidos", "quantidade_pedidos")
METHOD_VALUE_ALIASES = ("valor_total_processado", "valor_pago")


def resolve_col(df: DataFrame, aliases: Sequence[str], default: Column | None = None) -> Column | None:
    """SRC11: first alias present in ``df.columns``; else ``default``."""
    for a in aliases:
        if a in df.columns:
            return F.col(a)
    return default


def kpis(revenue: DataFrame) -> DataFrame:
    """TR9 + AG4 + AG5: one row with total revenue, total orders and the
    overall average ticket (0 when there are no orders)."""
    rev = resolve_col(revenue, REVENUE_ALIASES, F.lit(0))
    n = resolve_col(revenue, ORDERS_ALIASES, F.lit(0))
    agg = revenue.agg(F.coalesce(F.sum(rev), F.lit(0)).cast("decimal(38,2)").alias("faturamento_total"),
                      F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("total_pedidos"))
    ticket = F.when(F.col("total_pedidos") > 0,
                    F.round(F.col("faturamento_total").cast("double") / F.col("total_pedidos"), 2)) \
        .otherwise(F.lit(0.0))
    return agg.withColumn("ticket_medio_geral", ticket)


def kpis_formatted(revenue: DataFrame) -> DataFrame:
    """NUM8: KPI row plus display texts."""
    k = kpis(revenue)
    return k.select("*",
                    fmt_brl_display("faturamento_total").alias("faturamento_total_fmt"),
                    fmt_int_display("total_pedidos").alias("total_pedidos_fmt"),
                    fmt_brl_display("ticket_medio_geral").alias("ticket_medio_geral_fmt"))


def revenue_by_month(revenue: DataFrame) -> DataFrame:
    """AG6 + SRT1."""
    m = resolve_col(revenue, MONTH_ALIASES)
    return revenue.groupBy(m.alias("mes_ano")).agg(
        F.sum(resolve_col(revenue, REVENUE_ALIASES)).cast("decimal(38,2)").alias("faturamento_total")) \
        .orderBy(F.col("mes_ano").asc_nulls_last())


def top_customers(revenue: DataFrame, k: int = 10) -> DataFrame:
    """AG7 + SRT3: revenue per customer name, top ``k`` (name breaks ties).
    ``orderBy().limit()`` plans as TakeOrderedAndProject: each partition
    keeps only ``k`` rows before the single merge."""
    name = resolve_col(revenue, NAME_ALIASES)
    g = revenue.groupBy(name.alias("nome_cliente")).agg(
        F.sum(resolve_col(revenue, REVENUE_ALIASES)).cast("decimal(38,2)").alias("faturamento_total"))
    return g.orderBy(F.col("faturamento_total").desc_nulls_last(), F.col("nome_cliente").asc_nulls_last()).limit(k)


def revenue_by_state(revenue: DataFrame) -> DataFrame:
    """AG8 + SRT2."""
    return revenue.groupBy("estado").agg(
        F.sum(resolve_col(revenue, REVENUE_ALIASES)).cast("decimal(38,2)").alias("faturamento_total")) \
        .orderBy(F.col("faturamento_total").desc_nulls_last(), F.col("estado").asc_nulls_last())


def method_share(methods: DataFrame) -> DataFrame:
    """AG9 + WIN2: value per method, percent of the grand total and its label.
    The total is that of the few rows per method; pass a written table, as it is read for both."""
    v = resolve_col(methods, METHOD_VALUE_ALIASES)
    per = methods.groupBy("metodo_pagamento").agg(F.sum(v).cast("decimal(38,2)").alias("valor"))
    total = per.agg(F.sum("valor").cast("double").alias("t")).scalar()
    pct = F.when(total != 0, F.round(F.col("valor").cast("double") / total * 100, 2)).otherwise(F.lit(0.0))
    return per.select("metodo_pagamento", "valor", pct.alias("percentual")) \
        .withColumn("rotulo", fmt_pct_display("percentual"))


def method_volume(methods: DataFrame) -> DataFrame:
    """AG10: transactions per method."""
    return methods.groupBy("metodo_pagamento").agg(
        F.sum("quantidade_transacoes").cast("bigint").alias("quantidade_transacoes"))


def build_marts(revenue: DataFrame | None, methods: DataFrame | None) -> dict[str, DataFrame]:
    """All dashboard data sets for the gold tables that are present."""
    out: dict[str, DataFrame] = {}
    if revenue is not None:
        out["kpis"] = kpis_formatted(revenue)
        if resolve_col(revenue, MONTH_ALIASES) is not None and resolve_col(revenue, REVENUE_ALIASES) is not None:
            out["faturamento_por_mes"] = revenue_by_month(revenue)
        if resolve_col(revenue, NAME_ALIASES) is not None and resolve_col(revenue, REVENUE_ALIASES) is not None:
            out["top_clientes"] = top_customers(revenue)
        if "estado" in revenue.columns and resolve_col(revenue, REVENUE_ALIASES) is not None:
            out["faturamento_por_estado"] = revenue_by_state(revenue)
    if methods is not None and "metodo_pagamento" in methods.columns:
        if resolve_col(methods, METHOD_VALUE_ALIASES) is not None:
            out["participacao_metodos"] = method_share(methods)
        if "quantidade_transacoes" in methods.columns:
            out["volume_metodos"] = method_volume(methods)
    return out


__all__ = ["build_marts", "resolve_col", "kpis", "kpis_formatted", "revenue_by_month", "top_customers", "revenue_by_state",
           "method_share", "method_volume", "fmt_brl_display"]
