"""Registry of runnable queries over the driver tables.

Every query reads the driver tables (through the dirty text views of
``strata.plans.dirty``) and runs one operator or model of the library on
them. ``QUERIES`` maps a stable key to ``fn(spark, sf_dir) -> DataFrame``.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ..functions import dates, numbers, recode, text
from ..session import checkpoint_root, scratch_path
from ..sources import readers, sinks, snapshots
from ..streaming.ingest import stream_bronze
from . import jobs
from ..operators import audit, dedup, integrity, marts, quality, recoding, reconcile
from . import dirty
from .audit_clean import clean_customers_a, clean_orders_a, clean_payments_a
from .gold import payment_methods_month, revenue_customer_month
from .lenient import revenue_lenient, silver_customers_lenient, silver_orders_lenient, silver_payments_lenient
from .silver import silver_customers, silver_orders, silver_payments

AS_OF = "2026-01-01"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(arg):
    """``@register`` (key = function name) or ``@register("key")``."""
    if isinstance(arg, str):
        def deco(fn):
            QUERIES[arg] = fn
            return fn
        return deco
    QUERIES[arg.__name__] = arg
    return arg


# -- shared model builders ----------------------------------------------------

def s_customers(spark, sf, as_of=AS_OF):
    return silver_customers(dirty.dirty_customers(spark, sf), as_of=as_of)


# The S models and what each is built from. A model that feeds another is
# written first: joins on it then read shuffled files, which adaptive execution can
# split when one key is hot (it does not split the output of a window).
S_INPUTS = {
    "stg_clientes": (),
    "stg_pedidos": ("stg_clientes",),
    "stg_pagamentos": ("stg_pedidos",),
    "faturamento_cliente_mensal": ("stg_pedidos", "stg_clientes"),
    "resumo_metodos_pagamento": ("stg_pagamentos", "stg_pedidos"),
}


_WRITTEN: dict[tuple, DataFrame] = {}


def s_written(spark, sf, *names):
    """The named S models as written tables. Each is written once per application, like a layer that the
    last build left, with whatever it needs and nothing else."""
    out = {}
    for n in names:
        key = (checkpoint_root(spark), spark.sparkContext.applicationId, sf, n)
        if key not in _WRITTEN:
            _WRITTEN[key] = sinks.materialize(s_model(spark, sf, n), f"{scratch_path(spark, 'models')}/{n}")
        out[n] = _WRITTEN[key]
    return out


def s_model(spark, sf, name):
    """An S model, lazy, over written inputs."""
    inputs = list(s_written(spark, sf, *S_INPUTS[name]).values())
    if name == "stg_clientes":
        return s_customers(spark, sf)
    if name == "stg_pedidos":
        return silver_orders(dirty.dirty_orders(spark, sf), *inputs, as_of=AS_OF)
    if name == "stg_pagamentos":
        return silver_payments(dirty.dirty_payments(spark, sf), *inputs)
    return (revenue_customer_month if name == "faturamento_cliente_mensal" else payment_methods_month)(*inputs)


# -- silver / gold models (TR1-TR5) -------------------------------------------

@register("silver_customers")
def q_silver_customers(spark, sf):
    return s_customers(spark, sf)


@register("silver_orders")
def q_silver_orders(spark, sf):
    return s_model(spark, sf, "stg_pedidos")


@register("silver_payments")
def q_silver_payments(spark, sf):
    return s_model(spark, sf, "stg_pagamentos")


@register
def gold_revenue_customer_month(spark, sf):
    return s_model(spark, sf, "faturamento_cliente_mensal")


@register
def gold_payment_methods(spark, sf):
    return s_model(spark, sf, "resumo_metodos_pagamento")


@register
def gold_rebuild_replaces(spark, sf):
    """A full rebuild of the gold mart without its early months: they go."""
    t = s_written(spark, sf, "stg_clientes", "stg_pedidos")
    path = scratch_path(spark, "gold-rebuild")
    for since in ("2000-01-01", "2000-07-01"):
        orders = t["stg_pedidos"].where(F.col("data_pedido") >= F.lit(since).cast("date"))
        sinks.write_layer(revenue_customer_month(orders, t["stg_clientes"]), path, partition_by=["mes_ano"])
    return spark.read.parquet(path).withColumn("mes_ano", F.col("mes_ano").cast("string"))


@register
def gold_load_named_months(spark, sf):
    """A load of three named months, one of them without rows any more, into a mart whose months are
    marked (amounts one higher): the others keep their mark, the named ones are new."""
    t = s_written(spark, sf, "stg_clientes", "stg_pedidos")
    path = scratch_path(spark, "gold-months")
    whole = revenue_customer_month(t["stg_pedidos"], t["stg_clientes"])
    sinks.write_layer(whole.withColumn("faturamento_total", F.col("faturamento_total") + 1), path, partition_by=["mes_ano"])
    day = F.col("data_pedido")
    orders = t["stg_pedidos"].where(F.date_format(day, "yyyy-MM").isin("2000-07", "2000-09"))
    sinks.replace_partitions(revenue_customer_month(orders, t["stg_clientes"]), path, "mes_ano",
                             ["2000-07", "2000-08", "2000-09"])
    return spark.read.parquet(path).withColumn("mes_ano", F.col("mes_ano").cast("string"))


# -- date expressions (DT1-DT7) ------------------------------------------------

@register
def parse_date_multi(spark, sf):
    o = dirty.dirty_orders(spark, sf)
    return o.select("_linha", "data_pedido", dates.parse_date_multi("data_pedido").alias("data_convertida"))


@register
def clean_dates(spark, sf):
    c = dirty.dirty_customers(spark, sf)
    d = dates.clamp_date(dates.parse_date_multi("data_cadastro"), as_of=AS_OF)
    return c.select("_linha", "data_cadastro", d.alias("data_valida"))


@register
def parse_date_strict(spark, sf):
    p = dirty.dirty_payments(spark, sf)
    return p.select("_linha", "data_pagamento", dates.parse_date_strict("data_pagamento").alias("data_iso"))


@register
def parse_date_coerce(spark, sf):
    o = dirty.dirty_orders(spark, sf)
    return o.select("_linha", "data_pedido", dates.parse_date_coerce("data_pedido", "yyyy-MM-dd").alias("data_coerce"),
                    dates.month_text_nat(dates.parse_date_coerce("data_pedido", "yyyy-MM-dd")).alias("mes"))


# -- number expressions (NUM1-NUM3) ---------------------------------------------

@register
def parse_brl(spark, sf):
    o = dirty.dirty_orders(spark, sf)
    return o.select("_linha", "valor_total",
                    numbers.parse_brl("valor_total", "literal").alias("valor_literal"),
                    numbers.parse_brl("valor_total", "auto").alias("valor_auto"))


@register
def num_coerce_zero(spark, sf):
    p = dirty.dirty_payments(spark, sf)
    return p.select("_linha", "valor_pago", numbers.coerce_double_zero("valor_pago").alias("valor_num"))


@register
def cast_int_tolerant(spark, sf):
    o = dirty.dirty_orders(spark, sf)
    return o.select("_linha", "cliente_id", numbers.to_int_tolerant("cliente_id", "int").alias("cliente_int"),
                    numbers.to_int_tolerant("pedido_id", "bigint").alias("pedido_big"))


# -- text expressions and recoding (STR*, RC*) ---------------------------------

@register
def normalize_text(spark, sf):
    c = dirty.dirty_customers(spark, sf)
    return c.select("_linha", F.trim("nome").alias("nome_trim"), F.upper("estado").alias("estado_upper"),
                    F.lower("email").alias("email_lower"), text.strip_ws("email").alias("email_strip"))


@register
def title_case_words(spark, sf):
    c = dirty.dirty_customers(spark, sf)
    return c.select("_linha", "nome", text.title_words("nome").alias("nome_initcap"),
                    text.title_words_explicit("nome").alias("nome_split"))


@register
def title_case_letters(spark, sf):
    c = dirty.dirty_customers(spark, sf)
    return c.select("_linha", "nome", text.title_letters(text.strip_ws("nome")).alias("nome_title"))


@register
def recode_state(spark, sf):
    c = dirty.dirty_customers(spark, sf)
    return c.select("_linha", "estado", recode.recode_state("estado").alias("estado_uf"))


@register
def recode_map_table(spark, sf):
    """Two maps that are tables: a few raw status texts, and as many keys as there are customers."""
    o = dirty.dirty_orders(spark, sf)
    texts = o.select(F.upper(F.trim("status")).alias("raw")).distinct()
    status = sinks.materialize(texts.select("raw", recode.recode_status("raw").alias("code"))
                               .where(F.col("raw") != F.col("code")), scratch_path(spark, "map-status"))
    client = sinks.materialize(s_customers(spark, sf).select(F.col("cliente_id").cast("string").alias("id"), "estado"),
                               scratch_path(spark, "map-cliente"))
    out = recoding.recode_from_table(o, F.upper(F.trim("status")), "status_padrao", status, "raw", "code")
    out = recoding.recode_from_table(out, F.col("cliente_id").try_cast("double").try_cast("bigint").cast("string"),
                                     "estado_cliente", client, "id", "estado", unknown=F.lit("N/D"))
    return out.select("_linha", "status", "status_padrao", "cliente_id", "estado_cliente")


@register
def recode_status(spark, sf):
    o = dirty.dirty_orders(spark, sf)
    return o.select("_linha", "status", recode.recode_status("status").alias("status_padrao"))


@register
def recode_method(spark, sf):
    p = dirty.dirty_payments(spark, sf)
    return p.select("_linha", "metodo_pagamento", recode.recode_method("metodo_pagamento").alias("metodo_padrao"))


@register
def recode_exact_keep(spark, sf):
    c = dirty.dirty_customers(spark, sf)
    return c.select("_linha", "estado", recode.recode_keep("estado", recode.STATE_A).alias("estado_uf"))


@register
def recode_exact_default(spark, sf):
    o = dirty.dirty_orders(spark, sf)
    return o.select("_linha", "status", recode.recode_default("status", recode.STATUS_A,
                                                               recode.STATUS_A_DEFAULT).alias("status_padrao"))


@register
def recode_exact_null(spark, sf):
    p = dirty.dirty_payments(spark, sf)
    return p.select("_linha", "metodo_pagamento",
                    recode.lookup("metodo_pagamento", recode.METHOD_A).alias("metodo_padrao"))


@register
def recode_status_lenient(spark, sf):
    o = dirty.dirty_orders(spark, sf)
    return o.select("_linha", "status", recode.recode_status_lenient("status").alias("status_padrao"))


@register
def fill_defaults(spark, sf):
    c = dirty.dirty_customers(spark, sf)
    return c.select("_linha", "email", text.email_normalized("email").alias("email_s"),
                    text.email_lower_fill("email").alias("email_d"), text.email_fill("email").alias("email_a"))


# -- dedup and integrity (WIN1, SET*, JN*) ------------------------------------

@register
def dedup_full_row(spark, sf):
    return dedup.distinct_rows(dirty.dirty_orders(spark, sf))


@register
def dedup_best_row(spark, sf):
    c = dirty.dirty_customers(spark, sf).withColumn(
        "data_valida", dates.clamp_date(dates.parse_date_multi("data_cadastro"), as_of=AS_OF))
    return dedup.best_row_per_key(c, "cliente_id", [F.col("data_valida").asc_nulls_last(), F.col("_linha").asc()])


@register
def dedup_best_row_agg(spark, sf):
    c = dirty.dirty_customers(spark, sf).withColumn(
        "data_valida", dates.clamp_date(dates.parse_date_multi("data_cadastro"), as_of=AS_OF))
    return dedup.best_row_aggregate(c, "cliente_id", [("data_valida", True), ("_linha", True)])


@register
def dedup_first_by_key(spark, sf):
    return dedup.first_by_key(dirty.dirty_payments(spark, sf), "pagamento_id", dirty.PAYMENT_ORDER)


@register
def fk_filter_semi(spark, sf):
    o = dirty.dirty_orders(spark, sf).withColumn("cliente_int", numbers.to_int_tolerant("cliente_id", "int"))
    return integrity.fk_filter(o, s_written(spark, sf, "stg_clientes")["stg_clientes"], "cliente_int", "cliente_id", how="semi") \
        .select("_linha", "pedido_id", "cliente_id", "cliente_int")


@register
def fk_filter_inner_fanout(spark, sf):
    p = dirty.dirty_payments(spark, sf).withColumn("pedido_big", numbers.to_int_tolerant("pedido_id", "bigint"))
    return integrity.fk_filter(p, s_written(spark, sf, "stg_pedidos")["stg_pedidos"], "pedido_big", "pedido_id", how="inner") \
        .select("_linha", "pagamento_id", "pedido_big")


# -- profile A: audit, cleaning, reconciliation (TR8, DQ6-DQ8) ---------------

def _typed_a(spark, sf):
    c = dirty.dirty_customers(spark, sf).select(numbers.to_int_tolerant("cliente_id").alias("cliente_id"))
    o = dirty.dirty_orders(spark, sf).select(numbers.to_int_tolerant("pedido_id").alias("pedido_id"),
                                             numbers.to_int_tolerant("cliente_id").alias("cliente_id"))
    p = dirty.dirty_payments(spark, sf).select(numbers.to_int_tolerant("pagamento_id").alias("pagamento_id"),
                                               numbers.to_int_tolerant("pedido_id").alias("pedido_id"))
    return c, o, p


@register
def audit_orphans_orders(spark, sf):
    c, o, _ = _typed_a(spark, sf)
    return audit.orphan_rows(o, c, "cliente_id", "cliente_id", ["pedido_id", "cliente_id"])


@register
def audit_orphans_payments(spark, sf):
    _, o, p = _typed_a(spark, sf)
    return audit.orphan_rows(p, o, "pedido_id", "pedido_id", ["pagamento_id", "pedido_id"])


def _orphan_counts(spark, sf):
    c, o, p = _typed_a(spark, sf)
    return [audit.orphan_count(o, c, "cliente_id", "cliente_id", "pedidos"),
            audit.orphan_count(p, o, "pedido_id", "pedido_id", "pagamentos")]


@register
def audit_orphans(spark, sf):
    a, b = _orphan_counts(spark, sf)
    return a.unionByName(b)


def _raw3(spark, sf):
    return {"clientes": dirty.dirty_customers(spark, sf), "pedidos": dirty.dirty_orders(spark, sf),
            "pagamentos": dirty.dirty_payments(spark, sf)}


_KEYS = {"clientes": "cliente_id", "pedidos": "pedido_id", "pagamentos": "pagamento_id"}


def _null_parts(spark, sf):
    return [audit.null_counts(df, t) for t, df in _raw3(spark, sf).items()]


def _dupkey_parts(spark, sf):
    return [audit.duplicate_keys(df, t, _KEYS[t]) for t, df in _raw3(spark, sf).items()]


def _duprow_parts(spark, sf):
    return [audit.duplicate_rows(df, t) for t, df in _raw3(spark, sf).items()]


def _union(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register
def audit_null_counts(spark, sf):
    return _union(_null_parts(spark, sf))


@register
def audit_duplicate_keys(spark, sf):
    return _union(_dupkey_parts(spark, sf))


@register
def audit_duplicate_rows(spark, sf):
    return _union(_duprow_parts(spark, sf))


@register
def audit_report(spark, sf):
    tables = {t: (df, _KEYS[t]) for t, df in _raw3(spark, sf).items()}
    return audit.audit_report_profiled(tables, _orphan_counts(spark, sf))


@register
def profile_a_clean_customers(spark, sf):
    return clean_customers_a(dirty.dirty_customers(spark, sf))


@register
def profile_a_clean_orders(spark, sf):
    return clean_orders_a(dirty.dirty_orders(spark, sf))


@register
def profile_a_clean_payments(spark, sf):
    return clean_payments_a(dirty.dirty_payments(spark, sf))


@register
def reconcile_join(spark, sf):
    return reconcile.reconcile_join(clean_orders_a(dirty.dirty_orders(spark, sf)),
                                    clean_payments_a(dirty.dirty_payments(spark, sf)))


@register
def reconcile_divergence(spark, sf):
    return reconcile.divergences(clean_orders_a(dirty.dirty_orders(spark, sf)),
                                 clean_payments_a(dirty.dirty_payments(spark, sf)))


# -- profile D: lenient silver and gold (TR6, TR7) ----------------------------

def d_customers(spark, sf):
    return silver_customers_lenient(dirty.dirty_customers(spark, sf))


def d_orders(spark, sf):
    return silver_orders_lenient(dirty.dirty_orders(spark, sf))


@register("silver_customers_lenient")
def q_silver_customers_lenient(spark, sf):
    return d_customers(spark, sf)


@register("silver_orders_lenient")
def q_silver_orders_lenient(spark, sf):
    return d_orders(spark, sf)


@register("silver_payments_lenient")
def q_silver_payments_lenient(spark, sf):
    return silver_payments_lenient(dirty.dirty_payments(spark, sf), ordinal=dirty.PAYMENT_ORDER)


@register
def gold_revenue_lenient(spark, sf):
    return revenue_lenient(d_orders(spark, sf), d_customers(spark, sf))


# -- data-quality tests on the S models (DQ1-DQ5) ----------------------------

def _dq(spark, sf, test):
    checks = [c for c in quality.DECLARED_CHECKS if test in (None, c.test)]
    names = dict.fromkeys([c.table for c in checks] + [c.to for c in checks if c.to])
    return quality.run_checks(s_written(spark, sf, *names), checks)


@register
def dq_not_null(spark, sf):
    return _dq(spark, sf, "not_null")


@register
def dq_unique(spark, sf):
    return _dq(spark, sf, "unique")


@register
def dq_relationships(spark, sf):
    return _dq(spark, sf, "relationships")


@register
def dq_accepted_values(spark, sf):
    return quality.run_checks(s_written(spark, sf, "stg_pedidos"), [
        quality.accepted_values("stg_pedidos", "status", recode.ACCEPTED_STATUS_DECLARED),
        quality.accepted_values("stg_pedidos", "status", ("CONCLUÍDO", "PENDENTE", "CANCELADO"), severity="warn"),
    ])


@register
def dq_report(spark, sf):
    return _dq(spark, sf, None)


# -- reporting marts (TR9, TR10) -------------------------------------------

def _gold_s(spark, sf):
    return s_model(spark, sf, "faturamento_cliente_mensal")


def _methods_s(spark, sf):
    return s_written(spark, sf, "resumo_metodos_pagamento")["resumo_metodos_pagamento"]


@register
def mart_kpis(spark, sf):
    return marts.kpis(_gold_s(spark, sf))


@register
def mart_kpis_formatted(spark, sf):
    return marts.kpis_formatted(_gold_s(spark, sf))


@register
def mart_kpis_lenient(spark, sf):
    return marts.kpis(revenue_lenient(d_orders(spark, sf), d_customers(spark, sf)))


@register
def mart_revenue_by_month(spark, sf):
    return marts.revenue_by_month(_gold_s(spark, sf))


@register
def mart_top_customers(spark, sf):
    return marts.top_customers(_gold_s(spark, sf), 10)


@register
def mart_revenue_by_state(spark, sf):
    return marts.revenue_by_state(_gold_s(spark, sf))


@register
def mart_method_share(spark, sf):
    return marts.method_share(_methods_s(spark, sf))


@register
def mart_method_volume(spark, sf):
    return marts.method_volume(_methods_s(spark, sf))


# -- sources, sinks, snapshots, jobs (SRC*, SNK*) -----------------------------
# These write into a fresh folder under the shared checkpoint dir and read
# the result back.

ORDER_RAW = ["pedido_id", "cliente_id", "data_pedido", "valor_total", "status"]
CUSTOMER_RAW = ["cliente_id", "nome", "email", "estado", "data_cadastro"]
PAYMENT_RAW = ["pagamento_id", "pedido_id", "metodo_pagamento", "valor_pago", "data_pagamento"]


def write_raw_csv(df, path, null_token_col=None):
    """Land a DataFrame as raw CSV (header, spaces kept). With
    ``null_token_col`` its NULLs are written as the tokens NA/null/None."""
    if null_token_col:
        tokens = [t for t in readers.NULL_TOKENS if t]
        tok = F.element_at(F.array(*map(F.lit, tokens)), (F.pmod(F.xxhash64(*df.columns), F.lit(len(tokens))) + 1).cast("int"))
        df = df.withColumn(null_token_col, F.coalesce(F.col(null_token_col), tok))
    df.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).option("escape", '"').csv(path)


def write_raw_json(df, path):
    df.write.mode("overwrite").json(path)


def write_raw_json_arrays(df, path, rows_per_file=100_000, compression="none"):
    """Land rows as files that hold one JSON array each, of at most ``rows_per_file`` rows (an array is
    read by one task, so the number of files grows with the rows). A task closes its arrays as it goes, so no
    row is shuffled."""
    def arrays(batches):
        held = []
        for batch in batches:
            held += batch.column(0).to_pylist()
            while len(held) >= rows_per_file:
                yield pa.RecordBatch.from_pydict({"value": ["[" + ",".join(held[:rows_per_file]) + "]"]})
                del held[:rows_per_file]
        if held:
            yield pa.RecordBatch.from_pydict({"value": ["[" + ",".join(held) + "]"]})

    rows = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    rows.mapInArrow(arrays, "value string").write.mode("overwrite").option("maxRecordsPerFile", 1) \
        .option("compression", compression).text(path)


@register
def src_csv_text(spark, sf):
    path = scratch_path(spark, "raw-pedidos-csv")
    write_raw_csv(dirty.dirty_orders(spark, sf), path, null_token_col="valor_total")
    return readers.read_csv_text(spark, path, ORDER_RAW + ["_linha"])


@register
def src_csv_dialect(spark, sf):
    """Doubled quotes, line breaks in quotes and every null token."""
    path = scratch_path(spark, "raw-clientes-csv")
    c = dirty.dirty_customers(spark, sf)
    c = c.withColumn("nome", F.concat("nome", F.lit(' "'), "estado", F.lit('"\nlinha 2, '), "cliente_id"))
    write_raw_csv(c.repartition(8), path, null_token_col="email")
    return readers.read_csv_text(spark, path, CUSTOMER_RAW, multi_line=True)


@register
def src_csv_header_order(spark, sf):
    """Columns stand in the file in another order than the caller names them."""
    path = scratch_path(spark, "raw-clientes-csv")
    write_raw_csv(dirty.dirty_customers(spark, sf).select(*CUSTOMER_RAW[::-1]).repartition(4), path)
    return readers.read_source(spark, path, None, CUSTOMER_RAW)


@register
def src_csv_typed(spark, sf):
    path = scratch_path(spark, "raw-pedidos-csv")
    write_raw_csv(dirty.dirty_orders(spark, sf), path)
    schema = ("pedido_id BIGINT, cliente_id DOUBLE, data_pedido STRING, valor_total STRING, status STRING, "
              "_linha INT")
    return readers.read_csv_typed(spark, path, schema)


@register
def src_json_text(spark, sf):
    path = scratch_path(spark, "raw-pagamentos-json")
    write_raw_json(dirty.dirty_payments(spark, sf), path)
    return readers.read_json_text(spark, path, PAYMENT_RAW + ["_linha"])


@register
def src_json_array_text(spark, sf):
    path = f"{scratch_path(spark, 'raw-pagamentos')}.json"
    write_raw_json_arrays(dirty.dirty_payments(spark, sf), path, compression="gzip")
    return readers.read_source(spark, path, None, PAYMENT_RAW + ["_linha"], multi_line=True)


@register
def src_json_typed(spark, sf):
    path = scratch_path(spark, "raw-pagamentos-json")
    p = dirty.dirty_payments(spark, sf)
    write_raw_json_arrays(p.withColumns({k: F.col(k).cast("bigint") for k in ("pagamento_id", "pedido_id")}), path,
                          compression="gzip")
    schema = ("pagamento_id BIGINT, pedido_id BIGINT, metodo_pagamento STRING, valor_pago STRING, "
              "data_pagamento STRING, _linha BIGINT")
    return readers.read_json_typed(spark, path, schema, multi_line=True)


@register
def src_parquet_layer(spark, sf):
    root = scratch_path(spark, "bronze")
    sinks.write_layer(dirty.dirty_customers(spark, sf), f"{root}/clientes")
    return readers.read_layer(spark, root, "clientes")


@register
def snapshot_latest(spark, sf):
    root = scratch_path(spark, "snap-pedidos")
    snapshots.write_snapshot(dirty.dirty_orders(spark, sf), root)
    snapshots.write_snapshot(dedup.distinct_rows(dirty.dirty_orders(spark, sf)), root)
    return snapshots.read_snapshot(spark, root)


@register
def snapshot_as_of(spark, sf):
    root = scratch_path(spark, "snap-clientes")
    snapshots.write_snapshot(dirty.dirty_customers(spark, sf), root)
    snapshots.write_snapshot(s_customers(spark, sf), root)
    return snapshots.read_snapshot(spark, root, version=1)


#: Rows that one task sorts when rows are landed in an order.
ROWS_PER_SORT = 1_000_000

_RAW: dict[tuple, list] = {}


def landed_raw(spark, sf):
    """Driver tables -> dirty raw files (CSV, CSV, JSON arrays) -> specs; landed once per application."""
    key = (checkpoint_root(spark), spark.sparkContext.applicationId, sf)
    if key not in _RAW:
        raw = scratch_path(spark, "raw")
        write_raw_csv(dirty.dirty_customers(spark, sf), f"{raw}/clientes", null_token_col="email")
        write_raw_csv(dirty.dirty_orders(spark, sf), f"{raw}/pedidos")
        write_raw_json_arrays(dirty.dirty_payments(spark, sf), f"{raw}/pagamentos", compression="gzip")
        _RAW[key] = [
            jobs.SourceSpec("clientes", f"{raw}/clientes", "csv", tuple(CUSTOMER_RAW), "_linha"),
            jobs.SourceSpec("pedidos", f"{raw}/pedidos", "csv", tuple(ORDER_RAW), "_linha"),
            jobs.SourceSpec("pagamentos", f"{raw}/pagamentos", "json", tuple(PAYMENT_RAW), "_linha", multi_line=True)]
    return _RAW[key]


def _bronze(spark, sf, name, columns):
    root = scratch_path(spark, "bronze")
    jobs.bronze_ingest(spark, landed_raw(spark, sf), root)
    b = spark.read.parquet(f"{root}/{name}")
    return b.where(F.col("_ingerido_em").isNotNull()).select(*columns, "_linha")


@register
def bronze_ingest(spark, sf):
    return _bronze(spark, sf, "pedidos", ORDER_RAW)


@register
def bronze_ingest_clientes(spark, sf):
    return _bronze(spark, sf, "clientes", CUSTOMER_RAW)


@register
def bronze_ingest_pagamentos(spark, sf):
    return _bronze(spark, sf, "pagamentos", PAYMENT_RAW)


@register
def dedup_first_file_order(spark, sf):
    """First row of each payment in the order of the files, which hold no line
    numbers: rows are landed in descending order of date, then of the rest."""
    path = scratch_path(spark, "raw-pagamentos-csv")
    order = [F.col(c).desc_nulls_last() for c in PAYMENT_RAW[::-1]]
    rows = dirty.dirty_payments(spark, sf).select(*PAYMENT_RAW)
    files = max(8, math.ceil(rows.count() / ROWS_PER_SORT))
    write_raw_csv(rows.repartitionByRange(files, *order).sortWithinPartitions(*order), path)
    spec = jobs.SourceSpec("pagamentos", path, "csv", tuple(PAYMENT_RAW))
    root = scratch_path(spark, "bronze")
    jobs.bronze_ingest(spark, [spec], root)
    b = readers.with_block_order(spark.read.parquet(f"{root}/pagamentos"))
    return dedup.first_by_key(b, "pagamento_id", readers.BLOCK_ORDER).select(*PAYMENT_RAW)


@register
def metrics_rowcounts(spark, sf):
    specs = landed_raw(spark, sf)
    counts = jobs.bronze_ingest(spark, specs, scratch_path(spark, "bronze"))
    return spark.createDataFrame(sorted(counts.items()), "tabela string, linhas bigint")


@register
def bronze_ingest_stream(spark, sf):
    """Columns stand in the files in another order than the caller names them, and quotes are doubled."""
    src = scratch_path(spark, "landing-pedidos")
    o = dirty.dirty_orders(spark, sf)
    write_raw_csv(o.withColumn("status", F.concat(F.lit('"'), "status", F.lit('", '))).select("_linha", *ORDER_RAW[::-1]), src)
    out = scratch_path(spark, "bronze-pedidos")
    stream_bronze(spark, src, ORDER_RAW + ["_linha"], out, scratch_path(spark, "stream-ckpt"))
    return spark.read.parquet(out).select(*ORDER_RAW, F.col("_linha").cast("bigint").alias("_linha"))


@register
def medallion_end_to_end(spark, sf):
    specs = landed_raw(spark, sf)
    bronze = scratch_path(spark, "bronze")
    jobs.bronze_ingest(spark, specs, bronze)
    out = scratch_path(spark, "lake")
    jobs.run_profile_s(spark, bronze, out, as_of=AS_OF)
    g = spark.read.parquet(f"{out}/gold/faturamento_cliente_mensal")
    return g.withColumn("mes_ano", F.col("mes_ano").cast("string"))


@register
def medallion_dq_report(spark, sf):
    specs = landed_raw(spark, sf)
    bronze = scratch_path(spark, "bronze")
    jobs.bronze_ingest(spark, specs, bronze)
    return jobs.run_profile_s(spark, bronze, scratch_path(spark, "lake"), as_of=AS_OF)


@register
def medallion_lenient_end_to_end(spark, sf):
    specs = landed_raw(spark, sf)
    bronze = scratch_path(spark, "bronze")
    jobs.bronze_ingest(spark, specs, bronze)
    return jobs.run_profile_d(spark, bronze, scratch_path(spark, "lake"), payment_order=dirty.PAYMENT_ORDER)
