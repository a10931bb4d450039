"""Profile D (lenient) silver and gold: TR6, TR7.

Lenient rules: light text normalisation, one fixed date format (anything
else NULL), numbers coerced with junk -> 0.0, dedup keeps the first row in
file order, orphans are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import PANDAS_MAX_DATE, PANDAS_MIN_DATE, month_text_nat, parse_date_coerce
from ..functions.numbers import coerce_double_zero, to_int_tolerant
from ..functions.recode import COMPLETED_D, recode_status_lenient
from ..functions.text import email_lower_fill, strip_ws
from ..operators.dedup import first_by_key

ORDER_DATE_FORMAT = "yyyy-MM-dd"
PAYMENT_DATE_FORMAT = "MM/dd/yyyy"
PANDAS_BOUNDS = (PANDAS_MIN_DATE, PANDAS_MAX_DATE)


def _ordinal(df: DataFrame, ordinal) -> list:
    """File-order columns carried under private names (raw columns may
    share a name with a typed output column)."""
    return [F.col(c).alias(f"__ord{i}") for i, c in enumerate(ordinal) if c in df.columns]


def _ord_names(df: DataFrame, ordinal) -> list[str]:
    return [f"__ord{i}" for i, c in enumerate(ordinal) if c in df.columns]


def silver_customers_lenient(bronze: DataFrame, ordinal=("_linha",)) -> DataFrame:
    typed = bronze.select(
        to_int_tolerant("cliente_id").alias("cliente_id"),
        strip_ws("nome").alias("nome"),
        email_lower_fill("email").alias("email"),
        F.upper("estado").alias("estado"),
        F.col("data_cadastro"),
        *_ordinal(bronze, ordinal),
    )
    out = first_by_key(typed, "cliente_id", _ord_names(bronze, ordinal), drop_null_key=False)
    return out.select("cliente_id", "nome", "email", "estado", "data_cadastro")


def silver_orders_lenient(bronze: DataFrame, date_format: str = ORDER_DATE_FORMAT,
                          ordinal=("_linha",)) -> DataFrame:
    typed = bronze.select(
        to_int_tolerant("pedido_id").alias("pedido_id"),
        to_int_tolerant("cliente_id").alias("cliente_id"),
        parse_date_coerce("data_pedido", date_format, PANDAS_BOUNDS).alias("data_pedido"),
        coerce_double_zero("valor_total").alias("valor_total"),
        recode_status_lenient("status").alias("status"),
        *_ordinal(bronze, ordinal),
    )
    out = first_by_key(typed, "pedido_id", _ord_names(bronze, ordinal), drop_null_key=True)
    return out.select("pedido_id", "cliente_id", "data_pedido", "valor_total", "status")


def silver_payments_lenient(bronze: DataFrame, date_format: str = PAYMENT_DATE_FORMAT,
                            ordinal=("_linha",)) -> DataFrame:
    typed = bronze.select(
        to_int_tolerant("pagamento_id").alias("pagamento_id"),
        to_int_tolerant("pedido_id").alias("pedido_id"),
        F.lower("metodo_pagamento").alias("metodo_pagamento"),
        coerce_double_zero("valor_pago").alias("valor_pago"),
        parse_date_coerce("data_pagamento", date_format, PANDAS_BOUNDS).alias("data_pagamento"),
        *_ordinal(bronze, ordinal),
    )
    out = first_by_key(typed, "pagamento_id", _ord_names(bronze, ordinal), drop_null_key=True)
    return out.select("pagamento_id", "pedido_id", "metodo_pagamento", "valor_pago", "data_pagamento")


def revenue_lenient(orders: DataFrame, customers: DataFrame, completed: str = COMPLETED_D) -> DataFrame:
    """TR7: completed orders per customer and month (``NaT`` for a missing
    date), NULL customer keys dropped, then every customer column appended
    by a left join (orphans keep NULL customer columns)."""
    done = orders.where(F.col("status") == completed) \
        .withColumn("mes", month_text_nat("data_pedido")) \
        .where(F.col("cliente_id").isNotNull())
    agg = done.groupBy("cliente_id", "mes").agg(
        F.count("pedido_id").alias("quantidade_pedidos"),
        F.round(F.sum("valor_total"), 2).alias("faturamento_total"),
    )
    return agg.join(customers, "cliente_id", "left").select(
        "cliente_id", "mes", "quantidade_pedidos", "faturamento_total", "nome", "email", "estado", "data_cadastro")
