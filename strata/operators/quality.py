"""Declarative data-quality checks (DQ1-DQ5) -> one report DataFrame.

A check list is plain data; :func:`run_checks` turns it into one lazy plan
whose rows are ``(tabela, coluna, teste, severidade, falhas, status)``.
All ``not_null`` checks of one table share a single aggregation pass; the
other tests are one aggregation each, and every test output is a single
row, so the final ``unionByName`` is tiny.

Semantics follow the common generic tests: ``unique``, ``relationships``
and ``accepted_values`` ignore NULL values; ``falhas`` is the number of
failing rows returned by the test query (duplicated key values, orphan
child rows, distinct unaccepted values).
"""

from __future__ import annotations

from dataclasses import dataclass
from dataclasses import field as dc_field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.recode import ACCEPTED_STATUS_DECLARED
from .integrity import missing_parents


@dataclass(frozen=True)
class Check:
    table: str
    column: str
    test: str                      # not_null | unique | relationships | accepted_values
    severity: str = "error"        # error | warn
    to: str | None = None          # relationships: parent table
    field: str | None = None       # relationships: parent column
    values: tuple = dc_field(default_factory=tuple)  # accepted_values


def not_null(table, column, severity="error"):
    return Check(table, column, "not_null", severity)


def unique(table, column, severity="error"):
    return Check(table, column, "unique", severity)


def relationships(table, column, to, field_, severity="error"):
    return Check(table, column, "relationships", severity, to=to, field=field_)


def accepted_values(table, column, values, severity="error"):
    return Check(table, column, "accepted_values", severity, values=tuple(values))


def _row(df: DataFrame, c: Check, failures_col) -> DataFrame:
    return df.agg(failures_col.cast("bigint").alias("falhas")).select(
        F.lit(c.table).alias("tabela"), F.lit(c.column).alias("coluna"), F.lit(c.test).alias("teste"),
        F.lit(c.severity).alias("severidade"), "falhas")


def _not_null_rows(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    """All not_null checks of one table in one pass, unpivoted."""
    aggs = [F.count_if(F.col(c.column).isNull()).alias(f"c{i}") for i, c in enumerate(checks)]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c.column}', '{c.severity}', c{i}" for i, c in enumerate(checks))
    return wide.selectExpr(f"stack({len(checks)}, {stack}) as (coluna, severidade, falhas)").select(
        F.lit(table).alias("tabela"), "coluna", F.lit("not_null").alias("teste"), "severidade",
        F.col("falhas").cast("bigint").alias("falhas"))


def check_frame(tables: dict[str, DataFrame], c: Check) -> DataFrame:
    df = tables[c.table]
    col = F.col(c.column)
    if c.test == "unique":
        dup = df.where(col.isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        return _row(dup, c, F.count(F.lit(1)))
    if c.test == "relationships":
        miss = missing_parents(df.select(c.column), tables[c.to], c.column, c.field)
        return _row(miss, c, F.count(F.lit(1)))
    if c.test == "accepted_values":
        vals = df.where(col.isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")) \
            .where(~col.isin(list(c.values)))
        return _row(vals, c, F.count(F.lit(1)))
    if c.test == "not_null":
        return _not_null_rows(df, c.table, [c])
    raise ValueError(f"unknown test {c.test}")


def run_checks(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    parts = []
    nn: dict[str, list[Check]] = {}
    for c in checks:
        if c.test == "not_null":
            nn.setdefault(c.table, []).append(c)
        else:
            parts.append(check_frame(tables, c))
    for t, cs in nn.items():
        parts.append(_not_null_rows(tables[t], t, cs))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    status = F.when(F.col("falhas") == 0, "pass").when(F.col("severidade") == "warn", "warn").otherwise("fail")
    return out.withColumn("status", status)


def failed_errors(report: DataFrame) -> DataFrame:
    """DQ5: rows that should fail a job (error severity with failures)."""
    return report.where((F.col("severidade") == "error") & (F.col("falhas") > 0))


# The declared column tests of the S models (FIXTURES section 3).
DECLARED_CHECKS = [
    not_null("stg_clientes", "cliente_id"),
    unique("stg_clientes", "cliente_id"),
    not_null("stg_pedidos", "pedido_id"),
    unique("stg_pedidos", "pedido_id"),
    not_null("stg_pedidos", "cliente_id"),
    relationships("stg_pedidos", "cliente_id", "stg_clientes", "cliente_id"),
    accepted_values("stg_pedidos", "status", ACCEPTED_STATUS_DECLARED),
    not_null("stg_pagamentos", "pagamento_id"),
    unique("stg_pagamentos", "pagamento_id"),
    not_null("stg_pagamentos", "pedido_id"),
    relationships("stg_pagamentos", "pedido_id", "stg_pedidos", "pedido_id", severity="warn"),
    not_null("faturamento_cliente_mensal", "mes_ano"),
    not_null("faturamento_cliente_mensal", "cliente_id"),
    relationships("faturamento_cliente_mensal", "cliente_id", "stg_clientes", "cliente_id"),
    not_null("faturamento_cliente_mensal", "faturamento_total"),
    not_null("resumo_metodos_pagamento", "metodo_pagamento"),
]
