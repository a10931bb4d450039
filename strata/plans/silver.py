"""Profile S (canonical) silver tables: TR1-TR3.

Each function maps raw text (bronze) DataFrames to a typed silver
DataFrame; nothing is executed until the caller writes or collects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import DMY, clamp_date, parse_date_multi
from ..functions.numbers import parse_brl, to_int_strict, to_int_tolerant
from ..functions.recode import recode_method, recode_state, recode_status
from ..functions.text import email_normalized, title_words
from ..operators.dedup import best_row_per_key, distinct_rows
from ..operators.integrity import fk_filter
from ..sources.readers import FILE_ORDER

CUSTOMER_COLUMNS = ("cliente_id", "nome", "email", "estado", "data_cadastro")
ORDER_COLUMNS = ("pedido_id", "cliente_id", "data_pedido", "valor_total", "status")
PAYMENT_COLUMNS = ("pagamento_id", "pedido_id", "metodo_pagamento", "valor_pago", "data_pagamento")


def silver_customers(bronze: DataFrame, as_of=None, ordinal=FILE_ORDER) -> DataFrame:
    """TR1: typed, normalised customers; one row per ``cliente_id``, the
    earliest plausible registration date winning (NULL dates last)."""
    extra = [c for c in ordinal if c in bronze.columns]
    typed = bronze.select(
        to_int_strict("cliente_id", "int").alias("cliente_id"),
        title_words("nome").alias("nome"),
        email_normalized("email").alias("email"),
        recode_state("estado").alias("estado"),
        clamp_date(parse_date_multi("data_cadastro"), as_of=as_of).alias("data_cadastro"),
        *extra,
    )
    order = [F.col("data_cadastro").asc_nulls_last(), *(F.col(c).asc() for c in extra)]
    return best_row_per_key(typed, "cliente_id", order).select(*CUSTOMER_COLUMNS)


def silver_orders(bronze: DataFrame, customers: DataFrame, as_of=None, money_mode: str = "literal") -> DataFrame:
    """TR2: distinct raw rows -> tolerant types -> plausible dates only ->
    customer FK filter (semi join on the computed key)."""
    src = distinct_rows(bronze, ORDER_COLUMNS)
    typed = src.select(
        F.col("pedido_id").alias("__raw_id"),
        to_int_tolerant("pedido_id", "bigint").alias("pedido_id"),
        to_int_tolerant("cliente_id", "int").alias("cliente_id"),
        clamp_date(parse_date_multi("data_pedido"), as_of=as_of).alias("data_pedido"),
        parse_brl("valor_total", money_mode).alias("valor_total"),
        recode_status("status").alias("status"),
    ).where(F.col("__raw_id").isNotNull() & F.col("data_pedido").isNotNull())
    kept = fk_filter(typed, customers, "cliente_id", "cliente_id", how="semi")
    return kept.select(*ORDER_COLUMNS)


def silver_payments(bronze: DataFrame, orders: DataFrame, money_mode: str = "literal",
                    how: str = "inner") -> DataFrame:
    """TR3: typed payments whose order exists. ``how='inner'`` keeps one
    row per matching order row (parity); ``how='semi'`` one per payment."""
    typed = bronze.where(F.col("pagamento_id").isNotNull()).select(
        to_int_tolerant("pagamento_id", "bigint").alias("pagamento_id"),
        to_int_tolerant("pedido_id", "bigint").alias("pedido_id"),
        recode_method("metodo_pagamento").alias("metodo_pagamento"),
        parse_brl("valor_pago", money_mode).alias("valor_pago"),
        parse_date_multi("data_pagamento", formats=(DMY,)).alias("data_pagamento"),
    )
    return fk_filter(typed, orders, "pedido_id", "pedido_id", how=how).select(*PAYMENT_COLUMNS)
