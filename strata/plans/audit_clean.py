"""Profile A (audit) in-memory cleaning re-expressed as lazy plans: TR8."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_date_strict
from ..functions.numbers import coerce_double_zero, to_int_tolerant
from ..functions.recode import METHOD_A, STATE_A, STATUS_A, STATUS_A_DEFAULT, lookup, recode_default, recode_keep
from ..functions.text import email_fill, strip_ws, title_letters
from ..operators.dedup import distinct_rows, first_by_key


def clean_customers_a(raw: DataFrame, ordinal=("_linha",)) -> DataFrame:
    ords = [c for c in ordinal if c in raw.columns]
    typed = raw.select(
        to_int_tolerant("cliente_id").alias("cliente_id"),
        title_letters(strip_ws("nome")).alias("nome"),
        F.col("email"),
        recode_keep("estado", STATE_A).alias("estado"),
        F.col("data_cadastro"),
        *ords,
    ).withColumn("email", email_fill("email"))
    out = first_by_key(typed, "cliente_id", ords, drop_null_key=False)
    return out.select("cliente_id", "nome", "email", "estado", "data_cadastro")


def clean_orders_a(raw: DataFrame) -> DataFrame:
    src = distinct_rows(raw, ["pedido_id", "cliente_id", "data_pedido", "valor_total", "status"])
    return src.select(
        to_int_tolerant("pedido_id").alias("pedido_id"),
        to_int_tolerant("cliente_id").alias("cliente_id"),
        F.col("data_pedido"),
        coerce_double_zero("valor_total").alias("valor_total"),
        recode_default("status", STATUS_A, STATUS_A_DEFAULT).alias("status"),
    )


def clean_payments_a(raw: DataFrame) -> DataFrame:
    return raw.select(
        to_int_tolerant("pagamento_id").alias("pagamento_id"),
        to_int_tolerant("pedido_id").alias("pedido_id"),
        lookup("metodo_pagamento", METHOD_A).alias("metodo_pagamento"),
        coerce_double_zero("valor_pago").alias("valor_pago"),
        parse_date_strict("data_pagamento").alias("data_pagamento"),
    )
