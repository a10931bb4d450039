"""Profile S gold marts: TR4 (revenue per customer and month) and TR5
(payment methods per month)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_text
from ..functions.recode import COMPLETED_S

REVENUE_COLUMNS = ("mes_ano", "cliente_id", "nome_cliente", "email_cliente", "estado",
                   "total_pedidos", "faturamento_total", "ticket_medio")


def revenue_customer_month(orders: DataFrame, customers: DataFrame, completed: str = COMPLETED_S) -> DataFrame:
    """TR4: completed orders of known customers per customer and month,
    enriched with the customer columns.

    The "known customer" filter is applied *after* the aggregation:
    ``cliente_id`` is a grouping key, so filtering groups equals filtering
    rows, and the aggregation runs on the orders as given with map-side
    partial aggregates. Pass a written table: over a lazy chain that joins
    orders by customer the aggregate would reuse that partitioning, and one
    customer holding a large share of all orders would be summed by a
    single task."""
    done = orders.where(F.col("status") == completed)
    monthly = done.groupBy("cliente_id", month_text("data_pedido").alias("mes_ano")).agg(
        F.count_distinct("pedido_id").alias("total_pedidos"),
        F.sum("valor_total").cast("decimal(38,2)").alias("faturamento_total"),
        # the double average of decimals: an exact sum of cents, divided once
        (F.sum("valor_total").cast("decimal(38,2)") * 100).cast("double").alias("__cents"),
        F.count("valor_total").alias("__n"),
    )
    # "known customer" filter (semi join) + enrichment (left join) on the same
    # table and key is exactly one inner join: a row kept by the semi join has
    # at least one match, so the left join never pads it with NULLs.
    dim = customers.select(F.col("cliente_id").alias("__cid"), "nome", "email", "estado")
    out = monthly.join(dim, monthly["cliente_id"] == dim["__cid"], "inner")
    return out.select(
        "mes_ano",
        F.col("__cid").alias("cliente_id"),
        F.col("nome").alias("nome_cliente"),
        F.col("email").alias("email_cliente"),
        "estado",
        "total_pedidos",
        "faturamento_total",
        F.round(F.col("__cents") / (F.col("__n") * 100.0), 2).alias("ticket_medio"),
    )


def payment_methods_month(payments: DataFrame, orders: DataFrame, completed: str = COMPLETED_S) -> DataFrame:
    """TR5: payments of completed orders per month and method.

    A payment counts once per matching order row in the sum; the distinct
    count is immune. Payments are first totalled per (order, month, method,
    payment), which combines on the map side, so one scan serves both
    measures. The totals then meet the completed rows of their order in a
    plain inner join: both inputs come straight from a shuffle, so AQE can
    split an order that holds a large share of the payments."""
    paid = payments.groupBy("pedido_id", month_text("data_pagamento").alias("mes_ano"), "metodo_pagamento", "pagamento_id") \
        .agg(F.sum("valor_pago").alias("__v"))
    done = orders.where(F.col("status") == completed).select("pedido_id")
    return paid.join(done, "pedido_id").groupBy("mes_ano", "metodo_pagamento").agg(
        F.count_distinct("pagamento_id").alias("quantidade_transacoes"),
        F.sum("__v").cast("decimal(38,2)").alias("valor_total_processado"))
