"""Batch jobs: bronze ingest and the full layered builds (SNK5-SNK7).

Plans stay lazy inside a layer; a layer boundary is a write, and the next
layer reads the written table back, which also cuts the lineage (an
executor lost later recomputes from the written files, not from raw).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import marts, quality
from ..sources import readers, sinks
from .gold import payment_methods_month, revenue_customer_month
from .lenient import revenue_lenient, silver_customers_lenient, silver_orders_lenient, silver_payments_lenient
from .silver import CUSTOMER_COLUMNS, ORDER_COLUMNS, PAYMENT_COLUMNS, silver_customers, silver_orders, silver_payments


@dataclass(frozen=True)
class SourceSpec:
    name: str            # bronze table name
    path: str            # raw file or folder
    fmt: str             # csv | json
    columns: tuple       # raw column names (text schema)
    ordinal: str | None = None   # source line-number column, if the source has one
    multi_line: bool = False     # csv: line breaks in quotes; json: a file is one array


DEFAULT_SOURCES = (
    ("clientes", "csv", CUSTOMER_COLUMNS),
    ("pedidos", "csv", ORDER_COLUMNS),
    ("pagamentos", "json", PAYMENT_COLUMNS),
)


def ingest_one(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Raw text + ingest ordinal + ingest instant (SRC1/SRC3 + SNK1)."""
    cols = list(spec.columns) + ([spec.ordinal] if spec.ordinal else [])
    df = readers.read_source(spark, spec.path, spec.fmt, cols, spec.multi_line)
    if spec.ordinal:
        df = df.withColumn("_linha", F.col(spec.ordinal).try_cast("bigint"))
        if spec.ordinal != "_linha":
            df = df.drop(spec.ordinal)
    else:
        df = readers.with_file_order(df)
    return sinks.add_ingest_meta(df)


def bronze_ingest(spark: SparkSession, specs: list[SourceSpec], bronze_root: str) -> dict[str, int]:
    """SNK5: ordered load of every source into bronze; returns row counts
    gathered by observations during the write (no extra pass)."""
    counts = {}
    for spec in specs:
        df, obs = sinks.observed(ingest_one(spark, spec), f"bronze_{spec.name}")
        sinks.write_layer(df, f"{bronze_root.rstrip('/')}/{spec.name}")
        counts[spec.name] = int(obs.get.get("linhas", 0))
    return counts


def read_bronze(spark: SparkSession, bronze_root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{bronze_root.rstrip('/')}/{name}")


def file_order(bronze: DataFrame) -> tuple[str, ...]:
    """The columns that give source order in a bronze table."""
    return tuple(c for c in readers.FILE_ORDER if c in bronze.columns)


class QualityGateError(RuntimeError):
    """Raised when an error-severity data-quality test has failures."""


def run_profile_s(spark: SparkSession, bronze_root: str, out_root: str, as_of=None,
                  money_mode: str = "literal",
                  fail_on_error: bool = False) -> DataFrame:
    """SNK7: bronze -> silver (3 tables) -> gold (2 marts) -> DQ report.

    Returns the DQ report read from its written location. With
    ``fail_on_error`` (DQ5) the job raises when an error-severity test
    failed; warn-severity failures never fail the job."""
    out = out_root.rstrip("/")
    b = {n: read_bronze(spark, bronze_root, n) for n, _, _ in DEFAULT_SOURCES}
    sinks.write_layer(silver_customers(b["clientes"], as_of=as_of), f"{out}/silver/stg_clientes")
    c = spark.read.parquet(f"{out}/silver/stg_clientes")
    sinks.write_layer(silver_orders(b["pedidos"], c, as_of=as_of, money_mode=money_mode),
                      f"{out}/silver/stg_pedidos")
    o = spark.read.parquet(f"{out}/silver/stg_pedidos")
    sinks.write_layer(silver_payments(b["pagamentos"], o, money_mode=money_mode), f"{out}/silver/stg_pagamentos")
    p = spark.read.parquet(f"{out}/silver/stg_pagamentos")
    sinks.write_layer(revenue_customer_month(o, c), f"{out}/gold/faturamento_cliente_mensal",
                      partition_by=["mes_ano"])
    sinks.write_layer(payment_methods_month(p, o), f"{out}/gold/resumo_metodos_pagamento")
    tables = {"stg_clientes": c, "stg_pedidos": o, "stg_pagamentos": p,
              "faturamento_cliente_mensal": spark.read.parquet(f"{out}/gold/faturamento_cliente_mensal"),
              "resumo_metodos_pagamento": spark.read.parquet(f"{out}/gold/resumo_metodos_pagamento")}
    sinks.write_layer(quality.run_checks(tables, quality.DECLARED_CHECKS), f"{out}/quality/report")
    report = spark.read.parquet(f"{out}/quality/report")
    if fail_on_error:
        failed = quality.failed_errors(report).select("tabela", "coluna", "teste", "falhas").collect()
        if failed:   # at most one row per declared test
            raise QualityGateError(f"data-quality tests failed: {[tuple(r) for r in failed]}")
    return report


def run_marts(spark: SparkSession, gold_root: str, out_root: str) -> dict[str, str]:
    """TR9/TR10: build the reporting marts from whichever gold tables exist
    (SRC10: a missing table skips its marts; nothing found -> nothing built).
    Returns {mart name: written path}."""
    g = gold_root.rstrip("/")
    revenue = readers.read_optional(spark, [f"{g}/faturamento_cliente_mensal.parquet",
                                            f"{g}/faturamento_cliente_mensal"])
    methods = readers.read_optional(spark, [f"{g}/resumo_metodos_pagamento.parquet",
                                            f"{g}/resumo_metodos_pagamento"])
    built = {}
    for name, df in marts.build_marts(revenue, methods).items():
        path = f"{out_root.rstrip('/')}/{name}"
        sinks.write_layer(df, path)
        built[name] = path
    return built


def run_profile_d(spark: SparkSession, bronze_root: str, out_root: str, payment_order=None) -> DataFrame:
    """SNK6: lenient build of silver and gold. The first row of a key is the
    first in source order; ``payment_order`` overrides that of the payments."""
    out = out_root.rstrip("/")
    b = {n: read_bronze(spark, bronze_root, n) for n, _, _ in DEFAULT_SOURCES}
    order = {n: file_order(df) for n, df in b.items()}
    sinks.write_layer(silver_customers_lenient(b["clientes"], ordinal=order["clientes"]), f"{out}/lenient/stg_clientes")
    sinks.write_layer(silver_orders_lenient(b["pedidos"], ordinal=order["pedidos"]), f"{out}/lenient/stg_pedidos")
    sinks.write_layer(silver_payments_lenient(b["pagamentos"], ordinal=payment_order or order["pagamentos"]),
                      f"{out}/lenient/stg_pagamentos")
    sinks.write_layer(revenue_lenient(spark.read.parquet(f"{out}/lenient/stg_pedidos"),
                                      spark.read.parquet(f"{out}/lenient/stg_clientes")),
                      f"{out}/gold/faturamento_cliente_mensal")
    return spark.read.parquet(f"{out}/gold/faturamento_cliente_mensal")
