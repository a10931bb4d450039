"""Dirty raw-text views derived from the clean driver tables.

The driver tables (``orders``, ``customer``, ``lineitem``) are clean, so
both the Spark plans and the SQL oracles first build the *same* dirty text
views with plain modulo arithmetic on the keys (no randomness). Each view
has the raw schema of one business source (every column text) plus an
ingest ordinal ``_linha`` (file order).

The Spark builders scan each base table once: extra copies of a row are
generated with ``explode`` over a small per-row array instead of a
``union`` of several scans. Each view is landed once per application as
Parquet (see :func:`landed`) and then read like a raw/bronze table. The SQL
text of every view is generated from the same variant tables below, so
both sides always agree.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root, table_path

# Fixed fixture variants ----------------------------------------------------
# order status spellings by (o_orderstatus, o_orderkey % 4)
ORDER_STATUS_VARIANTS = {
    ("F", 0): "CONCLUIDO", ("F", 1): "concluido", ("F", 2): " Concluido ", ("F", 3): "CANCELADO",
    ("O", 0): "pendentte", ("O", 1): " PENDENTE ", ("O", 2): "PENDEDNTE", ("O", 3): "Pendente",
    ("P", 0): "cancelado", ("P", 1): "Cancelado", ("P", 2): "CONCLUIDO", ("P", 3): "PENDENTE",
}
# state spellings by c_nationkey % 12
STATE_VARIANTS = ["SP", "São Paulo", "rj", "RIO DE JANEIRO", "MG", "minas gerais",
                  "PARANÁ", " rs", "Rio Grande do Sul", "BA", "sc", "CE"]
# customer first names by c_custkey % 5 (prefix, suffix)
NAME_VARIANTS = [("ana ", ""), ("BRUNO ", ""), ("  maria  ", " "), ("o'neil-", " silva"), ("élio ávila ", "")]
# payment method spellings by (l_returnflag, l_linestatus, l_linenumber % 2)
METHOD_VARIANTS = {
    ("A", "F", 0): "PIX", ("A", "F", 1): "pix",
    ("A", "O", 0): " pix ", ("A", "O", 1): "Pix",
    ("N", "F", 0): "cartao_credito", ("N", "F", 1): "Cartão de Crédito",
    ("N", "O", 0): "CARTAO_CREDITO", ("N", "O", 1): "cartão de crédito",
    ("R", "F", 0): "Boleto", ("R", "F", 1): "boleto ",
    ("R", "O", 0): "Transferência", ("R", "O", 1): " ted ",
}
ORPHAN_CUSTOMER = "999999999"
RESEND_STATUS = "CONCLUIDO"
RESEND_AMOUNT = "R$ 10,00"


def _ptbr(x: Column) -> Column:
    return F.translate(F.format_number(x, 2), ",.", ".,")


def _case(pairs, default=None) -> Column:
    out = None
    for cond, val in pairs:
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out.otherwise(default) if default is not None else out


def _variant(table: dict, *parts: Column) -> Column:
    """Look a row's variant up in a literal map keyed by its parts joined
    with '|' (one map probe instead of a long CASE chain)."""
    args = []
    for key, v in table.items():
        args += [F.lit("|".join(str(x) for x in key)), F.lit(v)]
    return F.try_element_at(F.create_map(*args), F.concat_ws("|", *[p.cast("string") for p in parts]))


def _copies(*conds: Column) -> Column:
    """``explode`` source: copy 0 always, copy i when conds[i-1] holds
    (one CASE over the 2^n condition combinations, no lambda)."""
    n = len(conds)
    pairs = []
    for mask in range(2 ** n - 1, 0, -1):
        cond = None
        for i in range(n):
            if mask >> i & 1:
                cond = conds[i] if cond is None else (cond & conds[i])
        pairs.append((cond, F.array(F.lit(0), *[F.lit(i + 1) for i in range(n) if mask >> i & 1])))
    return F.explode(_case(pairs, F.array(F.lit(0))))


def _ymd(ts: Column):
    """Zero-padded year, month and day texts of a date/timestamp."""
    return (F.year(ts).cast("string"), F.lpad(F.month(ts).cast("string"), 2, "0"),
            F.lpad(F.dayofmonth(ts).cast("string"), 2, "0"))


def _money_plain(x: Column) -> Column:
    return x.cast("decimal(18,2)").cast("string")


def dirty_orders_from(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    y, m, dd = _ymd(F.col("o_orderdate"))
    ymd = F.concat(y, F.lit("-"), m, F.lit("-"), dd)
    dmy = F.concat(dd, F.lit("/"), m, F.lit("/"), y)
    data = _case([
        (k % 7 == 0, ymd),
        (k % 7 == 1, dmy),
        (k % 7 == 2, F.concat(ymd, F.lit(" "), F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":15:00"))),
        (k % 7 == 3, F.concat(dmy, F.lit(" 08:30:00"))),
        (k % 7 == 4, F.concat(y, F.lit("/"), m, F.lit("/"), dd)),
        (k % 7 == 5, F.concat(F.lit("2923-"), m, F.lit("-"), dd)),
    ], F.concat(y, F.lit("-45-"), dd))
    price = F.col("o_totalprice")
    valor = _case([
        (k % 11 == 0, F.lit(None).cast("string")),
        (k % 13 == 0, F.lit("abc")),
        (k % 5 == 0, _money_plain(price)),
    ], F.concat(F.lit("R$ "), _ptbr(price)))
    status = _variant(ORDER_STATUS_VARIANTS, F.col("o_orderstatus"), k % 4)
    cliente = _case([(k % 97 == 0, F.lit(ORPHAN_CUSTOMER)),
                     (k % 31 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))],
                    F.col("o_custkey").cast("string"))
    base = orders.select(
        k.alias("__k"),
        _copies(k % 10 == 0, k % 25 == 0).alias("__copy"),
        k.cast("string").alias("pedido_id"),
        cliente.alias("cliente_id"),
        data.alias("data_pedido"),
        valor.alias("valor_total"),
        status.alias("status"),
    )
    resend = F.col("__copy") == 2
    return base.select(
        "pedido_id", "cliente_id", "data_pedido",
        F.when(resend, F.lit(RESEND_AMOUNT)).otherwise(F.col("valor_total")).alias("valor_total"),
        F.when(resend, F.lit(RESEND_STATUS)).otherwise(F.col("status")).alias("status"),
        (F.col("__k") * 4 + F.col("__copy")).alias("_linha"),
    )


def dirty_customers_from(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    ks = k.cast("string")
    seg = F.lower(F.col("c_mktsegment"))
    idx = (k % len(NAME_VARIANTS) + 1).cast("int")
    nome = F.concat(F.element_at(F.array(*[F.lit(p) for p, _ in NAME_VARIANTS]), idx), seg, F.lit(" "), ks,
                    F.element_at(F.array(*[F.lit(s) for _, s in NAME_VARIANTS]), idx))
    email = _case([(k % 6 == 0, F.lit(None).cast("string")),
                   (k % 5 == 1, F.concat(F.lit(" Cliente"), ks, F.lit("@Mail.COM ")))],
                  F.concat(F.lit("cliente"), ks, F.lit("@mail.com")))
    estado = F.element_at(F.array(*[F.lit(v) for v in STATE_VARIANTS]),
                          (F.col("c_nationkey") % len(STATE_VARIANTS) + 1).cast("int"))
    d = F.date_add(F.lit("1998-01-01").cast("date"), ((k * 7) % 10000).cast("int"))
    y, m, dd = _ymd(d)
    ymd = F.concat(y, F.lit("-"), m, F.lit("-"), dd)
    data = _case([
        (k % 5 == 0, ymd),
        (k % 5 == 1, F.concat(dd, F.lit("/"), m, F.lit("/"), y)),
        (k % 5 == 2, F.concat(ymd, F.lit(" 10:00:00"))),
        (k % 5 == 3, F.concat(y, F.lit("/"), m, F.lit("/"), dd)),
    ], F.concat(y, F.lit("-45-"), dd))
    data2 = F.when(k % 26 == 0, F.date_sub(d, 10)).otherwise(F.date_add(d, 30)).cast("string")
    base = customer.select(
        k.alias("__k"), _copies(k % 13 == 0).alias("__copy"),
        F.when(k % 100 == 0, F.concat((k / 100).cast("bigint").cast("string"), F.lit("e2")))
        .when(k % 17 == 0, F.concat(ks, F.lit(".0"))).otherwise(ks).alias("cliente_id"),
        nome.alias("nome"), email.alias("email"),
        estado.alias("estado"), data.alias("data_cadastro"), data2.alias("__data2"))
    second = F.col("__copy") == 1
    return base.select(
        "cliente_id",
        F.when(second, F.upper("nome")).otherwise(F.col("nome")).alias("nome"),
        F.when(second, F.lit(None).cast("string")).otherwise(F.col("email")).alias("email"),
        "estado",
        F.when(second, F.col("__data2")).otherwise(F.col("data_cadastro")).alias("data_cadastro"),
        (F.col("__k") * 2 + F.col("__copy")).alias("_linha"),
    )


def dirty_payments_from(lineitem: DataFrame) -> DataFrame:
    p = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    price = F.col("l_extendedprice")
    pedido = F.when(p % 89 == 0, (F.lit(-1) - F.col("l_orderkey")).cast("string")) \
        .otherwise(F.col("l_orderkey").cast("string"))
    metodo = _variant(METHOD_VARIANTS, F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber") % 2)
    valor = _case([
        (p % 4 == 0, _money_plain(price)),
        (p % 4 == 1, F.concat(F.lit("R$ "), _ptbr(price))),
        (p % 4 == 2, _ptbr(price)),
        (p % 3 == 0, F.lit(None).cast("string")),
    ], F.concat(F.lit("R$ "), _ptbr(price)))
    y, m, dd = _ymd(F.col("l_shipdate"))
    data = F.when(p % 3 == 1, F.concat(y, F.lit("-"), m, F.lit("-"), dd)) \
        .otherwise(F.concat(dd, F.lit("/"), m, F.lit("/"), y))
    return lineitem.select(
        p.cast("string").alias("pagamento_id"), pedido.alias("pedido_id"), metodo.alias("metodo_pagamento"),
        valor.alias("valor_pago"), data.alias("data_pagamento"), p.alias("_linha"))


# Landed views: each dirty view is written once per Spark application as
# Parquet under the shared checkpoint folder (the folder name is unique per
# application) and every query scans it, like a bronze table. Query plans
# then have the production shape (scan -> parse -> ...) instead of carrying
# the fixture expressions inline.
_LANDED: dict[tuple, str] = {}
_LOCK = threading.Lock()
_BUILDERS = {"dirty_orders": ("orders", dirty_orders_from), "dirty_customers": ("customer", dirty_customers_from),
             "dirty_payments": ("lineitem", dirty_payments_from)}


def landed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    root = checkpoint_root(spark)
    key = (root, os.path.abspath(sf_dir), name)
    with _LOCK:
        path = _LANDED.get(key)
        if path is None:
            base, build = _BUILDERS[name]
            tag = hashlib.sha1(key[1].encode()).hexdigest()[:10]
            path = f"{root.rstrip('/')}/fixtures-{tag}-{uuid.uuid4().hex[:8]}/{name}"
            build(spark.read.parquet(table_path(sf_dir, base))).write.mode("overwrite").parquet(path)
            _LANDED[key] = path
    return spark.read.parquet(path)


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "dirty_orders")


def dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "dirty_customers")


def dirty_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "dirty_payments")


# Tie-break for "first in file order" on payments: _linha is not unique
# (lineitem has repeated (orderkey, linenumber)), so the remaining columns
# break ties; rows equal on all of them are identical.
PAYMENT_ORDER = ("_linha", "pedido_id", "metodo_pagamento", "valor_pago", "data_pagamento")


# ---------------------------------------------------------------------------
# The same views as DuckDB SQL text (used by the SQL oracles).

def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_ptbr(x: str) -> str:
    return f"translate(format('{{:,.2f}}', {x}), ',.', '.,')"


def dirty_orders_sql() -> str:
    status = "CASE " + " ".join(
        f"WHEN o_orderstatus = {_q(s)} AND o_orderkey % 4 = {m} THEN {_q(v)}"
        for (s, m), v in ORDER_STATUS_VARIANTS.items()) + " END"
    base = f"""SELECT o_orderkey AS k,
      CAST(o_orderkey AS VARCHAR) AS pedido_id,
      CASE WHEN o_orderkey % 97 = 0 THEN {_q(ORPHAN_CUSTOMER)}
           WHEN o_orderkey % 31 = 0 THEN CAST(o_custkey AS VARCHAR) || '.0'
           ELSE CAST(o_custkey AS VARCHAR) END AS cliente_id,
      CASE o_orderkey % 7
        WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
        WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
        WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') || ' ' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':15:00'
        WHEN 3 THEN strftime(o_orderdate, '%d/%m/%Y') || ' 08:30:00'
        WHEN 4 THEN strftime(o_orderdate, '%Y/%m/%d')
        WHEN 5 THEN '2923' || strftime(o_orderdate, '-%m-%d')
        ELSE strftime(o_orderdate, '%Y') || '-45-' || strftime(o_orderdate, '%d') END AS data_pedido,
      CASE WHEN o_orderkey % 11 = 0 THEN NULL
           WHEN o_orderkey % 13 = 0 THEN 'abc'
           WHEN o_orderkey % 5 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
           ELSE 'R$ ' || {_sql_ptbr('o_totalprice')} END AS valor_total,
      {status} AS status
    FROM orders"""
    return f"""SELECT pedido_id, cliente_id, data_pedido, valor_total, status, k * 4 AS _linha FROM ({base}) b
    UNION ALL SELECT pedido_id, cliente_id, data_pedido, valor_total, status, k * 4 + 1 FROM ({base}) b WHERE k % 10 = 0
    UNION ALL SELECT pedido_id, cliente_id, data_pedido, {_q(RESEND_AMOUNT)}, {_q(RESEND_STATUS)}, k * 4 + 2
      FROM ({base}) b WHERE k % 25 = 0"""


def dirty_customers_sql() -> str:
    seg = "lower(c_mktsegment)"
    ks = "CAST(c_custkey AS VARCHAR)"
    nome = "CASE " + " ".join(
        f"WHEN c_custkey % 5 = {i} THEN {_q(p)} || {seg} || ' ' || {ks} || {_q(s)}"
        for i, (p, s) in enumerate(NAME_VARIANTS)) + " END"
    estado = "CASE " + " ".join(
        f"WHEN c_nationkey % {len(STATE_VARIANTS)} = {i} THEN {_q(v)}"
        for i, v in enumerate(STATE_VARIANTS)) + " END"
    d = "(DATE '1998-01-01' + CAST((c_custkey * 7) % 10000 AS INTEGER))"
    base = f"""SELECT c_custkey AS k,
      CASE WHEN c_custkey % 100 = 0 THEN CAST(c_custkey // 100 AS VARCHAR) || 'e2'
           WHEN c_custkey % 17 = 0 THEN {ks} || '.0' ELSE {ks} END AS cliente_id, {nome} AS nome,
      CASE WHEN c_custkey % 6 = 0 THEN NULL
           WHEN c_custkey % 5 = 1 THEN ' Cliente' || {ks} || '@Mail.COM '
           ELSE 'cliente' || {ks} || '@mail.com' END AS email,
      {estado} AS estado,
      CASE c_custkey % 5
        WHEN 0 THEN strftime({d}, '%Y-%m-%d')
        WHEN 1 THEN strftime({d}, '%d/%m/%Y')
        WHEN 2 THEN strftime({d}, '%Y-%m-%d') || ' 10:00:00'
        WHEN 3 THEN strftime({d}, '%Y/%m/%d')
        ELSE strftime({d}, '%Y') || '-45-' || strftime({d}, '%d') END AS data_cadastro,
      strftime(CASE WHEN c_custkey % 26 = 0 THEN {d} - 10 ELSE {d} + 30 END, '%Y-%m-%d') AS data2
    FROM customer"""
    return f"""SELECT cliente_id, nome, email, estado, data_cadastro, k * 2 AS _linha FROM ({base}) b
    UNION ALL SELECT cliente_id, upper(nome), CAST(NULL AS VARCHAR), estado, data2, k * 2 + 1
      FROM ({base}) b WHERE k % 13 = 0"""


def dirty_payments_sql() -> str:
    p = "(l_orderkey * 10 + l_linenumber)"
    metodo = "CASE " + " ".join(
        f"WHEN l_returnflag = {_q(f)} AND l_linestatus = {_q(s)} AND l_linenumber % 2 = {m} THEN {_q(v)}"
        for (f, s, m), v in METHOD_VARIANTS.items()) + " END"
    return f"""SELECT CAST({p} AS VARCHAR) AS pagamento_id,
      CASE WHEN {p} % 89 = 0 THEN CAST(-1 - l_orderkey AS VARCHAR) ELSE CAST(l_orderkey AS VARCHAR) END AS pedido_id,
      {metodo} AS metodo_pagamento,
      CASE WHEN {p} % 4 = 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)
           WHEN {p} % 4 = 1 THEN 'R$ ' || {_sql_ptbr('l_extendedprice')}
           WHEN {p} % 4 = 2 THEN {_sql_ptbr('l_extendedprice')}
           WHEN {p} % 3 = 0 THEN NULL
           ELSE 'R$ ' || {_sql_ptbr('l_extendedprice')} END AS valor_pago,
      CASE WHEN {p} % 3 = 1 THEN strftime(l_shipdate, '%Y-%m-%d') ELSE strftime(l_shipdate, '%d/%m/%Y') END
        AS data_pagamento,
      {p} AS _linha
    FROM lineitem"""


def with_dirty_sql(body: str) -> str:
    """Prefix a query with the three dirty views as CTEs."""
    return (f"WITH dirty_orders AS ({dirty_orders_sql()}),\n"
            f"dirty_customers AS ({dirty_customers_sql()}),\n"
            f"dirty_payments AS ({dirty_payments_sql()})\n{body}")
