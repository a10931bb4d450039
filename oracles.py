"""DuckDB SQL oracles for every registered query (see ``__spark_entry__``).

Written from the description of each model, not from its Spark plan: dates
are taken apart by patterns and built again, recodes are joins with value
tables, duplicates fall to ``arg_min``, and the marts group before they join.
All read the same dirty text views (``strata.plans.dirty``).
Fixed run date: ``DATE '2026-01-01'`` (the Spark side uses ``as_of``).
"""

from __future__ import annotations

from strata.plans.dirty import with_dirty_sql

AS_OF_SQL = "DATE '2026-01-01'"

# shapes of a date text: pattern, then the groups of year, month and day
_CLOCK = "([0-9]{1,2}):([0-9]{1,2}):([0-9]{1,2})"
_DASHED = ("^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})($|[ T][0-9])", 1, 2, 3)
_SLASHED = ("^([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})($|[ T][0-9])", 1, 2, 3)
_DAY_FIRST = ("^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})$", 3, 2, 1)
_DAY_FIRST_CLOCK = (f"^([0-9]{{1,2}})/([0-9]{{1,2}})/([0-9]{{4}}) {_CLOCK}$", 3, 2, 1)


def _date(c: str, *shapes) -> str:
    """The date of the shape that a text has; NULL for any other text and for days that do not exist."""
    def part(pattern, k):
        return f"CAST(regexp_extract(trim({c}), '{pattern}', {k}) AS BIGINT)"

    whens = " ".join(f"WHEN regexp_matches(trim({c}), '{p}') THEN TRY(make_date({part(p, y)}, {part(p, m)}, {part(p, d)}))"
                     for p, y, m, d in shapes)
    return f"(CASE {whens} END)"


def _multi_date(c: str) -> str:
    return _date(c, _DASHED, _SLASHED, _DAY_FIRST, _DAY_FIRST_CLOCK)


def _clamp(c: str) -> str:
    return f"(CASE WHEN {c} BETWEEN DATE '2000-01-01' AND {AS_OF_SQL} THEN {c} END)"


def _plain(c: str) -> str:
    """pt-BR money text without sign and thousands dots, with a decimal point."""
    return f"translate(regexp_replace({c}, 'R\\$|[.]', '', 'g'), ',', '.')"


def _brl(c: str) -> str:
    return f"ifnull(TRY_CAST({_plain(c)} AS DECIMAL(10,2)), 0::DECIMAL(10,2))"


def _brl_auto(c: str) -> str:
    return (f"ifnull(TRY_CAST(if(regexp_matches({c}, 'R\\$|,'), {_plain(c)}, trim({c})) AS DECIMAL(10,2)), "
            f"0::DECIMAL(10,2))")


def _title_words(c: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower(trim({c})), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


def _values(name: str, pairs: dict[str, str]) -> str:
    rows = ", ".join(f"('{k}', '{v}')" for k, v in pairs.items())
    return f"(VALUES {rows}) {name}(k, v)"


# Spellings and what they stand for.
STATES = {"SÃO PAULO": "SP", "RIO DE JANEIRO": "RJ", "MINAS GERAIS": "MG", "PARANÁ": "PR", "RIO GRANDE DO SUL": "RS"}
STATUSES = {"CONCLUIDO": "CONCLUÍDO", "PENDENTTE": "PENDENTE", "CANCELADO": "CANCELADO"}
METHODS = {"cartao_credito": "Cartão de Crédito", "cartão de crédito": "Cartão de Crédito", "pix": "PIX", "boleto": "Boleto"}


def _recoded(table: str, column: str, key: str, pairs: dict[str, str], unknown: str, alias: str) -> str:
    """``table`` with ``alias``: the value of ``key`` in ``pairs``, or ``unknown``."""
    return (f"SELECT t.*, ifnull(m.v, {unknown}) AS {alias} FROM {table} t "
            f"LEFT JOIN {_values('m', pairs)} ON m.k = {key}")


def stg_clientes_sql() -> str:
    """One row a customer: that with the earliest plausible date, missing dates last, then the first line."""
    rows = _recoded("dirty_customers", "estado", "upper(trim(t.estado))", STATES, "upper(trim(t.estado))", "uf")
    return f"""SELECT id AS cliente_id, best.nome AS nome, best.email AS email, best.uf AS estado, best.dia AS data_cadastro
    FROM (SELECT id, arg_min({{'nome': nome_ok, 'email': email_ok, 'uf': uf, 'dia': dia}},
                             ifnull(strftime(dia, '%Y%m%d'), '99999999') || lpad(CAST(_linha AS VARCHAR), 20, '0')) AS best
          FROM (SELECT CAST(cliente_id AS INTEGER) AS id, {_title_words('nome')} AS nome_ok,
                       ifnull(trim(lower(email)), 'nao_informado@email.com') AS email_ok, uf, _linha,
                       {_clamp(_multi_date('data_cadastro'))} AS dia
                FROM ({rows}) r)
          WHERE id IS NOT NULL GROUP BY id)"""


def stg_pedidos_sql(money: str = "literal") -> str:
    """Different rows with an id, a plausible date and a known customer."""
    brl = _brl if money == "literal" else _brl_auto
    rows = _recoded("(SELECT pedido_id, cliente_id, data_pedido, valor_total, status FROM dirty_orders GROUP BY ALL)",
                    "status", "upper(trim(t.status))", STATUSES, "upper(trim(t.status))", "situacao")
    return f"""SELECT * FROM (
      SELECT TRY_CAST(pedido_id AS BIGINT) AS pedido_id, TRY_CAST(cliente_id AS INTEGER) AS cliente_id,
             {_clamp(_multi_date('data_pedido'))} AS data_pedido, {brl('valor_total')} AS valor_total, situacao AS status
      FROM ({rows}) r WHERE pedido_id IS NOT NULL)
    WHERE data_pedido IS NOT NULL AND cliente_id IN (SELECT cliente_id FROM stg_clientes)"""


def stg_pagamentos_sql(money: str = "literal") -> str:
    """A row for each payment with an id and each row of its order."""
    brl = _brl if money == "literal" else _brl_auto
    rows = _recoded("dirty_payments", "metodo_pagamento", "lower(trim(t.metodo_pagamento))", METHODS,
                    "trim(t.metodo_pagamento)", "metodo")
    return f"""SELECT TRY_CAST(pagamento_id AS BIGINT) AS pagamento_id, o.pedido_id, metodo AS metodo_pagamento,
           {brl('valor_pago')} AS valor_pago, {_date('data_pagamento', _DASHED, _SLASHED, _DAY_FIRST)} AS data_pagamento
    FROM (SELECT pedido_id, unnest(range(count(*))) FROM stg_pedidos GROUP BY pedido_id) o
    JOIN ({rows}) p ON o.pedido_id = TRY_CAST(p.pedido_id AS BIGINT)
    WHERE p.pagamento_id IS NOT NULL"""


STATE_SQL = f"SELECT _linha, estado, uf AS estado_uf FROM ({_recoded('dirty_customers', 'estado', 'upper(trim(t.estado))', STATES, 'upper(trim(t.estado))', 'uf')}) r"
STATUS_SQL = f"SELECT _linha, status, s AS status_padrao FROM ({_recoded('dirty_orders', 'status', 'upper(trim(t.status))', STATUSES, 'upper(trim(t.status))', 's')}) r"
METHOD_SQL = f"SELECT _linha, metodo_pagamento, m AS metodo_padrao FROM ({_recoded('dirty_payments', 'metodo_pagamento', 'lower(trim(t.metodo_pagamento))', METHODS, 'trim(t.metodo_pagamento)', 'm')}) r".replace(" m(k, v)", " x(k, v)").replace("m.v", "x.v").replace("m.k", "x.k")


def _with(body: str, money: str = "literal", extra: str = "") -> str:
    """Dirty views + silver models + gold marts (+ ``extra`` CTEs), then ``body``."""
    head = with_dirty_sql("")
    extra = (",\n" + extra) if extra else ""
    return (head.rstrip() + f""",
stg_clientes AS ({stg_clientes_sql()}),
stg_pedidos AS ({stg_pedidos_sql(money)}),
stg_pagamentos AS ({stg_pagamentos_sql(money)}),
faturamento AS ({FATURAMENTO_BODY}),
resumo AS ({RESUMO_BODY}){extra}
{body}""")


FATURAMENTO_BODY = """SELECT mes_ano, cliente_id, nome AS nome_cliente, email AS email_cliente, estado,
         total_pedidos, faturamento_total, round(media, 2) AS ticket_medio
  FROM (SELECT cliente_id, strftime(data_pedido, '%Y-%m') AS mes_ano, count(DISTINCT pedido_id) AS total_pedidos,
               sum(valor_total)::DECIMAL(38,2) AS faturamento_total, avg(valor_total) AS media
        FROM stg_pedidos WHERE status = 'CONCLUÍDO' GROUP BY ALL)
  JOIN stg_clientes USING (cliente_id)"""

RESUMO_BODY = """SELECT strftime(data_pagamento, '%Y-%m') AS mes_ano, metodo_pagamento,
         count(DISTINCT pagamento_id) AS quantidade_transacoes, sum(valor_pago * vezes)::DECIMAL(38,2) AS valor_total_processado
  FROM stg_pagamentos
  JOIN (SELECT pedido_id, count(*) AS vezes FROM stg_pedidos WHERE status = 'CONCLUÍDO' GROUP BY pedido_id) USING (pedido_id)
  GROUP BY ALL"""


def _strict_iso(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL THEN NULL WHEN contains({c}, '/') "
            f"THEN strftime(strptime({c}, '%d/%m/%Y'), '%Y-%m-%d') "
            f"ELSE strftime(strptime({c}, '%Y-%m-%d'), '%Y-%m-%d') END")


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def _title_letters(c: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({c}, '(\\p{{L}}+|\\P{{L}}+)'), "
            f"lambda r: upper(r[1]) || lower(r[2:])), '')")


def _num(c: str) -> str:
    return f"coalesce(try_cast(trim({c}) AS DOUBLE), 0.0)"


STATE_A_CASE = """coalesce(CASE estado WHEN 'São Paulo' THEN 'SP' WHEN 'SP' THEN 'SP' WHEN 'RJ' THEN 'RJ'
    WHEN 'MG' THEN 'MG' WHEN 'PR' THEN 'PR' WHEN 'RS' THEN 'RS' END, estado)"""
STATUS_A_CASE = """coalesce(CASE status WHEN 'CONCLUIDO' THEN 'CONCLUÍDO' WHEN 'concluido' THEN 'CONCLUÍDO'
    WHEN 'pendentte' THEN 'PENDENTE' WHEN 'CANCELADO' THEN 'CANCELADO' END, 'INDEFINIDO')"""
METHOD_A_CASE = """CASE metodo_pagamento WHEN 'cartao_credito' THEN 'Cartão de Crédito'
    WHEN 'Cartão de Crédito' THEN 'Cartão de Crédito' WHEN 'PIX' THEN 'PIX' WHEN 'pix' THEN 'PIX'
    WHEN 'Boleto' THEN 'Boleto' END"""
PAY_ORDER = ("_linha, pedido_id NULLS FIRST, metodo_pagamento NULLS FIRST, valor_pago NULLS FIRST, "
             "data_pagamento NULLS FIRST")

A_CUSTOMERS = f"""SELECT cliente_id, nome, email, estado, data_cadastro FROM (
  SELECT try_cast(cliente_id AS BIGINT) AS cliente_id, {_title_letters(_strip('nome'))} AS nome,
         coalesce(email, 'nao_informado@email.com') AS email, {STATE_A_CASE} AS estado, data_cadastro,
         row_number() OVER (PARTITION BY try_cast(cliente_id AS BIGINT) ORDER BY _linha) AS rn
  FROM dirty_customers) t WHERE rn = 1"""
A_ORDERS = f"""SELECT try_cast(pedido_id AS BIGINT) AS pedido_id, try_cast(cliente_id AS BIGINT) AS cliente_id,
  data_pedido, {_num('valor_total')} AS valor_total, {STATUS_A_CASE} AS status
  FROM (SELECT DISTINCT pedido_id, cliente_id, data_pedido, valor_total, status FROM dirty_orders) d"""
A_PAYMENTS = f"""SELECT try_cast(pagamento_id AS BIGINT) AS pagamento_id, try_cast(pedido_id AS BIGINT) AS pedido_id,
  {METHOD_A_CASE} AS metodo_pagamento, {_num('valor_pago')} AS valor_pago,
  {_strict_iso('data_pagamento')} AS data_pagamento FROM dirty_payments"""

D_CUSTOMERS = f"""SELECT cliente_id, nome, email, estado, data_cadastro FROM (
  SELECT try_cast(cliente_id AS BIGINT) AS cliente_id, {_strip('nome')} AS nome,
         coalesce(lower(email), 'nao_informado@email.com') AS email, upper(estado) AS estado, data_cadastro,
         row_number() OVER (PARTITION BY try_cast(cliente_id AS BIGINT) ORDER BY _linha) AS rn
  FROM dirty_customers) t WHERE rn = 1"""
D_ORDERS = f"""SELECT pedido_id, cliente_id, data_pedido, valor_total, status FROM (
  SELECT try_cast(pedido_id AS BIGINT) AS pedido_id, try_cast(cliente_id AS BIGINT) AS cliente_id,
         CASE WHEN CAST(try_strptime(trim(data_pedido), '%Y-%m-%d') AS DATE)
                   BETWEEN DATE '1677-09-22' AND DATE '2262-04-11'
              THEN CAST(try_strptime(trim(data_pedido), '%Y-%m-%d') AS DATE) END AS data_pedido,
         {_num('valor_total')} AS valor_total,
         CASE upper(status) WHEN 'PENDENTTE' THEN 'PENDENTE' ELSE upper(status) END AS status,
         row_number() OVER (PARTITION BY try_cast(pedido_id AS BIGINT) ORDER BY _linha) AS rn
  FROM dirty_orders) t WHERE rn = 1 AND pedido_id IS NOT NULL"""
D_PAYMENTS = f"""SELECT pagamento_id, pedido_id, metodo_pagamento, valor_pago, data_pagamento FROM (
  SELECT try_cast(pagamento_id AS BIGINT) AS pagamento_id, try_cast(pedido_id AS BIGINT) AS pedido_id,
         lower(metodo_pagamento) AS metodo_pagamento, {_num('valor_pago')} AS valor_pago,
         CASE WHEN CAST(try_strptime(trim(data_pagamento), '%m/%d/%Y') AS DATE)
                   BETWEEN DATE '1677-09-22' AND DATE '2262-04-11'
              THEN CAST(try_strptime(trim(data_pagamento), '%m/%d/%Y') AS DATE) END AS data_pagamento,
         row_number() OVER (PARTITION BY try_cast(pagamento_id AS BIGINT) ORDER BY {PAY_ORDER}) AS rn
  FROM dirty_payments) t WHERE rn = 1 AND pagamento_id IS NOT NULL"""
D_GOLD = """SELECT g.cliente_id, g.mes, g.quantidade_pedidos, g.faturamento_total,
       c.nome, c.email, c.estado, c.data_cadastro
  FROM (SELECT cliente_id, coalesce(strftime(data_pedido, '%Y-%m'), 'NaT') AS mes,
               count(pedido_id) AS quantidade_pedidos, round(sum(valor_total), 2) AS faturamento_total
        FROM d_orders WHERE status = 'CONCLUIDO' AND cliente_id IS NOT NULL GROUP BY 1, 2) g
  LEFT JOIN d_customers c ON g.cliente_id = c.cliente_id"""

TYPED_A = """a_c AS (SELECT try_cast(cliente_id AS BIGINT) AS cliente_id FROM dirty_customers),
a_o AS (SELECT try_cast(pedido_id AS BIGINT) AS pedido_id, try_cast(cliente_id AS BIGINT) AS cliente_id
        FROM dirty_orders),
a_p AS (SELECT try_cast(pagamento_id AS BIGINT) AS pagamento_id, try_cast(pedido_id AS BIGINT) AS pedido_id
        FROM dirty_payments)"""
ORPHAN_O = ("SELECT pedido_id, cliente_id FROM a_o o WHERE NOT EXISTS "
            "(SELECT 1 FROM a_c c WHERE c.cliente_id IS NOT DISTINCT FROM o.cliente_id)")
ORPHAN_P = ("SELECT pagamento_id, pedido_id FROM a_p p WHERE NOT EXISTS "
            "(SELECT 1 FROM a_o o WHERE o.pedido_id IS NOT DISTINCT FROM p.pedido_id)")
ORPHAN_COUNTS = (f"SELECT 'pedidos' AS tabela, (SELECT count(*) FROM ({ORPHAN_O}) x) AS orfaos "
                 f"UNION ALL SELECT 'pagamentos', (SELECT count(*) FROM ({ORPHAN_P}) y)")

RAW_COLS = {
    "clientes": ("dirty_customers", ["cliente_id", "nome", "email", "estado", "data_cadastro"], "cliente_id"),
    "pedidos": ("dirty_orders", ["pedido_id", "cliente_id", "data_pedido", "valor_total", "status"], "pedido_id"),
    "pagamentos": ("dirty_payments", ["pagamento_id", "pedido_id", "metodo_pagamento", "valor_pago",
                                      "data_pagamento"], "pagamento_id"),
}


def _null_counts_sql() -> str:
    parts = []
    for t, (v, cols, _) in RAW_COLS.items():
        for c in cols:
            parts.append(f"SELECT '{t}' AS tabela, '{c}' AS coluna, count(*) FILTER (WHERE {c} IS NULL) AS nulos "
                         f"FROM {v}")
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") n WHERE nulos > 0"


def _dup_keys_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS tabela, '{k}' AS coluna, count(*) - count(DISTINCT {k}) - "
        f"(CASE WHEN count(*) FILTER (WHERE {k} IS NULL) > 0 THEN 1 ELSE 0 END) AS duplicadas FROM {v}"
        for t, (v, _, k) in RAW_COLS.items())


def _dup_rows_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS tabela, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicadas FROM "
        f"(SELECT count(*) AS n FROM {v} GROUP BY {', '.join(cols)}) g"
        for t, (v, cols, _) in RAW_COLS.items())


# Declared tests: (table, column, test, severity, extra)
DQ_TESTS = [
    ("stg_clientes", "cliente_id", "not_null", "error", None),
    ("stg_clientes", "cliente_id", "unique", "error", None),
    ("stg_pedidos", "pedido_id", "not_null", "error", None),
    ("stg_pedidos", "pedido_id", "unique", "error", None),
    ("stg_pedidos", "cliente_id", "not_null", "error", None),
    ("stg_pedidos", "cliente_id", "relationships", "error", ("stg_clientes", "cliente_id")),
    ("stg_pedidos", "status", "accepted_values", "error", ("CONCLUIDO", "PENDENTE", "CANCELADO")),
    ("stg_pagamentos", "pagamento_id", "not_null", "error", None),
    ("stg_pagamentos", "pagamento_id", "unique", "error", None),
    ("stg_pagamentos", "pedido_id", "not_null", "error", None),
    ("stg_pagamentos", "pedido_id", "relationships", "warn", ("stg_pedidos", "pedido_id")),
    ("faturamento_cliente_mensal", "mes_ano", "not_null", "error", None),
    ("faturamento_cliente_mensal", "cliente_id", "not_null", "error", None),
    ("faturamento_cliente_mensal", "cliente_id", "relationships", "error", ("stg_clientes", "cliente_id")),
    ("faturamento_cliente_mensal", "faturamento_total", "not_null", "error", None),
    ("resumo_metodos_pagamento", "metodo_pagamento", "not_null", "error", None),
]
DQ_VIEW = {"stg_clientes": "stg_clientes", "stg_pedidos": "stg_pedidos", "stg_pagamentos": "stg_pagamentos",
           "faturamento_cliente_mensal": "faturamento", "resumo_metodos_pagamento": "resumo"}


def _dq_sql(tests) -> str:
    parts = []
    for t, c, test, sev, extra in tests:
        v = DQ_VIEW[t]
        if test == "not_null":
            f = f"(SELECT count(*) FROM {v} WHERE {c} IS NULL)"
        elif test == "unique":
            f = f"(SELECT count(*) FROM (SELECT {c} FROM {v} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) u)"
        elif test == "relationships":
            pt, pc = extra
            f = (f"(SELECT count(*) FROM {v} ch LEFT JOIN {DQ_VIEW[pt]} pa ON ch.{c} = pa.{pc} "
                 f"WHERE ch.{c} IS NOT NULL AND pa.{pc} IS NULL)")
        else:
            vals = ", ".join("'" + x + "'" for x in extra)
            f = f"(SELECT count(*) FROM (SELECT {c} FROM {v} GROUP BY {c}) a WHERE {c} NOT IN ({vals}))"
        parts.append(f"SELECT '{t}' AS tabela, '{c}' AS coluna, '{test}' AS teste, '{sev}' AS severidade, "
                     f"CAST({f} AS BIGINT) AS falhas")
    body = " UNION ALL ".join(parts)
    return (f"SELECT *, CASE WHEN falhas = 0 THEN 'pass' WHEN severidade = 'warn' THEN 'warn' ELSE 'fail' END "
            f"AS status FROM ({body}) r")


def _with_all(body: str) -> str:
    return _with(body, "literal", f"""a_customers AS ({A_CUSTOMERS}), a_orders AS ({A_ORDERS}),
a_payments AS ({A_PAYMENTS}), d_customers AS ({D_CUSTOMERS}), d_orders AS ({D_ORDERS}),
d_payments AS ({D_PAYMENTS}),
{TYPED_A}""")


def oracle_sql() -> dict[str, str]:
    q = {}
    q["silver_customers"] = _with("SELECT * FROM stg_clientes", "literal")
    q["silver_orders"] = _with("SELECT * FROM stg_pedidos", "literal")
    q["silver_payments"] = _with("SELECT * FROM stg_pagamentos", "literal")
    q["gold_revenue_customer_month"] = _with("SELECT * FROM faturamento", "literal")
    q["gold_payment_methods"] = _with("SELECT * FROM resumo", "literal")
    W = _with_all
    q["parse_date_multi"] = W(f"SELECT _linha, data_pedido, {_multi_date('data_pedido')} AS data_convertida "
                              f"FROM dirty_orders")
    q["clean_dates"] = W(f"SELECT _linha, data_cadastro, {_clamp(_multi_date('data_cadastro'))} AS data_valida "
                         f"FROM dirty_customers")
    q["parse_date_strict"] = W(f"SELECT _linha, data_pagamento, {_strict_iso('data_pagamento')} AS data_iso "
                               f"FROM dirty_payments")
    q["parse_date_coerce"] = W(
        "SELECT _linha, data_pedido, dc AS data_coerce, ifnull(strftime(dc, '%Y-%m'), 'NaT') AS mes FROM ("
        "SELECT _linha, data_pedido, if(d BETWEEN DATE '1677-09-22' AND DATE '2262-04-11', d, NULL) AS dc FROM ("
        f"SELECT *, {_date('data_pedido', ('^([0-9]+)-([0-9]{1,2})-([0-9]{1,2})$', 1, 2, 3))} AS d FROM dirty_orders) a) b")
    q["parse_brl"] = W(f"SELECT _linha, valor_total, {_brl('valor_total')} AS valor_literal, "
                       f"{_brl_auto('valor_total')} AS valor_auto FROM dirty_orders")
    q["num_coerce_zero"] = W(f"SELECT _linha, valor_pago, {_num('valor_pago')} AS valor_num FROM dirty_payments")
    q["cast_int_tolerant"] = W("SELECT _linha, cliente_id, try_cast(cliente_id AS INTEGER) AS cliente_int, "
                               "try_cast(pedido_id AS BIGINT) AS pedido_big FROM dirty_orders")
    q["normalize_text"] = W(f"SELECT _linha, trim(nome) AS nome_trim, upper(estado) AS estado_upper, "
                            f"lower(email) AS email_lower, {_strip('email')} AS email_strip FROM dirty_customers")
    q["title_case_words"] = W(f"SELECT _linha, nome, {_title_words('nome')} AS nome_initcap, "
                              f"{_title_words('nome')} AS nome_split FROM dirty_customers")
    q["title_case_letters"] = W(f"SELECT _linha, nome, {_title_letters(_strip('nome'))} AS nome_title "
                                f"FROM dirty_customers")
    q["recode_state"] = W(STATE_SQL)
    q["recode_status"] = W(STATUS_SQL)
    q["recode_method"] = W(METHOD_SQL)
    q["recode_exact_keep"] = W(f"SELECT _linha, estado, {STATE_A_CASE} AS estado_uf FROM dirty_customers")
    q["recode_exact_default"] = W(f"SELECT _linha, status, {STATUS_A_CASE} AS status_padrao FROM dirty_orders")
    q["recode_exact_null"] = W(f"SELECT _linha, metodo_pagamento, {METHOD_A_CASE} AS metodo_padrao "
                               f"FROM dirty_payments")
    q["recode_status_lenient"] = W("SELECT _linha, status, CASE upper(status) WHEN 'PENDENTTE' THEN 'PENDENTE' "
                                   "ELSE upper(status) END AS status_padrao FROM dirty_orders")
    q["fill_defaults"] = W("SELECT _linha, email, coalesce(lower(trim(email)), 'nao_informado@email.com') AS email_s, "
                           "coalesce(lower(email), 'nao_informado@email.com') AS email_d, "
                           "coalesce(email, 'nao_informado@email.com') AS email_a FROM dirty_customers")
    q["dedup_full_row"] = W("SELECT DISTINCT pedido_id, cliente_id, data_pedido, valor_total, status FROM dirty_orders")
    q["dedup_best_row"] = W(f"SELECT cliente_id, nome, email, estado, data_cadastro, _linha, data_valida FROM ("
                            f"SELECT *, row_number() OVER (PARTITION BY cliente_id ORDER BY data_valida ASC NULLS LAST, "
                            f"_linha) AS rn FROM (SELECT *, {_clamp(_multi_date('data_cadastro'))} AS data_valida "
                            f"FROM dirty_customers) a) b WHERE rn = 1 AND cliente_id IS NOT NULL")
    q["dedup_first_by_key"] = W(f"SELECT pagamento_id, pedido_id, metodo_pagamento, valor_pago, data_pagamento, _linha "
                                f"FROM (SELECT *, row_number() OVER (PARTITION BY pagamento_id ORDER BY {PAY_ORDER}) "
                                f"AS rn FROM dirty_payments) a WHERE rn = 1 AND pagamento_id IS NOT NULL")
    q["fk_filter_semi"] = W("SELECT _linha, pedido_id, cliente_id, try_cast(cliente_id AS INTEGER) AS cliente_int "
                            "FROM dirty_orders WHERE try_cast(cliente_id AS INTEGER) IN (SELECT cliente_id FROM stg_clientes)")
    q["fk_filter_inner_fanout"] = W("SELECT p._linha, p.pagamento_id, try_cast(p.pedido_id AS BIGINT) AS pedido_big "
                                    "FROM dirty_payments p JOIN stg_pedidos o ON try_cast(p.pedido_id AS BIGINT) = o.pedido_id")
    q["audit_orphans_orders"] = W(ORPHAN_O)
    q["audit_orphans_payments"] = W(ORPHAN_P)
    q["audit_orphans"] = W(ORPHAN_COUNTS)
    q["audit_null_counts"] = W(_null_counts_sql())
    q["audit_duplicate_keys"] = W(_dup_keys_sql())
    q["audit_duplicate_rows"] = W(_dup_rows_sql())
    q["audit_report"] = W(
        f"SELECT 'nulos' AS secao, tabela, coluna, nulos AS valor FROM ({_null_counts_sql()}) a "
        f"UNION ALL SELECT 'chaves_duplicadas', tabela, coluna, duplicadas FROM ({_dup_keys_sql()}) b "
        f"UNION ALL SELECT 'linhas_duplicadas', tabela, NULL, duplicadas FROM ({_dup_rows_sql()}) c "
        f"UNION ALL SELECT 'orfaos', tabela, NULL, orfaos FROM ({ORPHAN_COUNTS}) d")
    q["profile_a_clean_customers"] = W("SELECT * FROM a_customers")
    q["profile_a_clean_orders"] = W("SELECT * FROM a_orders")
    q["profile_a_clean_payments"] = W("SELECT * FROM a_payments")
    q["reconcile_join"] = W("SELECT o.pedido_id, o.cliente_id, o.data_pedido, o.valor_total, o.status, p.pagamento_id, "
                            "p.metodo_pagamento, p.valor_pago, p.data_pagamento FROM a_orders o JOIN a_payments p "
                            "ON o.pedido_id = p.pedido_id")
    q["reconcile_divergence"] = W("SELECT o.pedido_id, o.valor_total, p.valor_pago, o.valor_total - p.valor_pago AS "
                                  "diferenca FROM a_orders o JOIN a_payments p ON o.pedido_id = p.pedido_id "
                                  "WHERE abs(o.valor_total - p.valor_pago) > 0.01")
    q["silver_customers_lenient"] = W("SELECT * FROM d_customers")
    q["silver_orders_lenient"] = W("SELECT * FROM d_orders")
    q["silver_payments_lenient"] = W("SELECT * FROM d_payments")
    q["gold_revenue_lenient"] = W(D_GOLD)
    q["dq_not_null"] = W(_dq_sql([t for t in DQ_TESTS if t[2] == "not_null"]))
    q["dq_unique"] = W(_dq_sql([t for t in DQ_TESTS if t[2] == "unique"]))
    q["dq_relationships"] = W(_dq_sql([t for t in DQ_TESTS if t[2] == "relationships"]))
    q["dq_accepted_values"] = W(_dq_sql([
        ("stg_pedidos", "status", "accepted_values", "error", ("CONCLUIDO", "PENDENTE", "CANCELADO")),
        ("stg_pedidos", "status", "accepted_values", "warn", ("CONCLUÍDO", "PENDENTE", "CANCELADO"))]))
    q["dq_report"] = W(_dq_sql(DQ_TESTS))
    kpi = ("SELECT CAST(coalesce(sum(faturamento_total), 0) AS DECIMAL(38,2)) AS faturamento_total, "
           "CAST(coalesce(sum({n}), 0) AS BIGINT) AS total_pedidos FROM {t}")
    kpi_full = ("SELECT *, CASE WHEN total_pedidos > 0 THEN round(CAST(faturamento_total AS DOUBLE) / total_pedidos, 2) "
                "ELSE 0.0 END AS ticket_medio_geral FROM ({k}) k")
    q["mart_kpis"] = W(kpi_full.format(k=kpi.format(n="total_pedidos", t="faturamento")))
    q["mart_kpis_lenient"] = W(kpi_full.format(k=kpi.format(n="quantidade_pedidos", t=f"({D_GOLD})")))
    q["mart_kpis_formatted"] = W(
        "SELECT *, 'R$ ' || format('{:,.2f}', CAST(faturamento_total AS DOUBLE)) AS faturamento_total_fmt, "
        "format('{:,}', total_pedidos) AS total_pedidos_fmt, "
        "'R$ ' || format('{:,.2f}', ticket_medio_geral) AS ticket_medio_geral_fmt FROM ("
        + kpi_full.format(k=kpi.format(n="total_pedidos", t="faturamento")) + ") f")
    q["mart_revenue_by_month"] = W("SELECT mes_ano, CAST(sum(faturamento_total) AS DECIMAL(38,2)) AS faturamento_total "
                                   "FROM faturamento GROUP BY mes_ano ORDER BY mes_ano")
    q["mart_top_customers"] = W("SELECT nome_cliente, CAST(sum(faturamento_total) AS DECIMAL(38,2)) AS faturamento_total "
                                "FROM faturamento GROUP BY nome_cliente ORDER BY faturamento_total DESC, "
                                "nome_cliente LIMIT 10")
    q["mart_revenue_by_state"] = W("SELECT estado, CAST(sum(faturamento_total) AS DECIMAL(38,2)) AS faturamento_total "
                                   "FROM faturamento GROUP BY estado ORDER BY faturamento_total DESC")
    q["mart_method_share"] = W(
        "SELECT metodo_pagamento, valor, CASE WHEN t <> 0 THEN round(CAST(valor AS DOUBLE) / t * 100, 2) ELSE 0.0 END "
        "AS percentual, format('{:,.1f}%', round(CASE WHEN t <> 0 THEN round(CAST(valor AS DOUBLE) / t * 100, 2) "
        "ELSE 0.0 END, 1)) AS rotulo FROM (SELECT metodo_pagamento, CAST(sum(valor_total_processado) AS DECIMAL(38,2)) AS valor "
        "FROM resumo GROUP BY 1) a, (SELECT CAST(sum(valor_total_processado) AS DOUBLE) AS t FROM resumo) b")
    q["mart_method_volume"] = W("SELECT metodo_pagamento, CAST(sum(quantidade_transacoes) AS BIGINT) AS "
                                "quantidade_transacoes FROM resumo GROUP BY 1")
    order_raw = "pedido_id, cliente_id, data_pedido, valor_total, status"
    q["src_csv_text"] = W(f"SELECT {order_raw}, CAST(_linha AS VARCHAR) AS _linha FROM dirty_orders")
    q["src_csv_typed"] = W("SELECT CAST(pedido_id AS BIGINT) AS pedido_id, CAST(cliente_id AS DOUBLE) AS cliente_id, "
                           "data_pedido, valor_total, status, CAST(_linha AS INTEGER) AS _linha FROM dirty_orders")
    client_raw = "cliente_id, nome, email, estado, data_cadastro"
    q["src_csv_dialect"] = W("SELECT cliente_id, nome || ' \"' || estado || '\"' || chr(10) || 'linha 2, ' || cliente_id AS nome, "
                             "email, estado, data_cadastro FROM dirty_customers")
    q["src_csv_header_order"] = W(f"SELECT {client_raw} FROM dirty_customers")
    pay_raw = "pagamento_id, pedido_id, metodo_pagamento, valor_pago, data_pagamento"
    q["src_json_text"] = W(f"SELECT {pay_raw}, CAST(_linha AS VARCHAR) AS _linha FROM dirty_payments")
    q["src_json_array_text"] = q["src_json_text"]
    q["src_json_typed"] = W("SELECT CAST(pagamento_id AS BIGINT) AS pagamento_id, CAST(pedido_id AS BIGINT) AS pedido_id, "
                            "metodo_pagamento, valor_pago, data_pagamento, _linha FROM dirty_payments")
    q["src_parquet_layer"] = W("SELECT * FROM dirty_customers")
    q["snapshot_latest"] = W(f"SELECT DISTINCT {order_raw} FROM dirty_orders")
    q["snapshot_as_of"] = W("SELECT * FROM dirty_customers")
    q["bronze_ingest"] = W(f"SELECT {order_raw}, _linha FROM dirty_orders")
    q["bronze_ingest_clientes"] = W(f"SELECT {client_raw}, _linha FROM dirty_customers")
    q["bronze_ingest_pagamentos"] = W(f"SELECT {pay_raw}, _linha FROM dirty_payments")
    file_order = ", ".join(f"{c} DESC NULLS LAST" for c in pay_raw.split(", ")[::-1])
    q["dedup_first_file_order"] = W(f"SELECT DISTINCT ON (pagamento_id) {pay_raw} FROM dirty_payments "
                                    f"ORDER BY pagamento_id, {file_order}")
    q["gold_rebuild_replaces"] = W("SELECT * FROM faturamento WHERE mes_ano >= '2000-07'")
    q["metrics_rowcounts"] = W("SELECT 'clientes' AS tabela, count(*) AS linhas FROM dirty_customers UNION ALL "
                               "SELECT 'pagamentos', count(*) FROM dirty_payments UNION ALL "
                               "SELECT 'pedidos', count(*) FROM dirty_orders")
    q["bronze_ingest_stream"] = W("SELECT pedido_id, cliente_id, data_pedido, valor_total, "
                                  "'\"' || status || '\", ' AS status, _linha FROM dirty_orders")
    q["gold_load_named_months"] = W(
        "SELECT * REPLACE (CASE WHEN mes_ano IN ('2000-07', '2000-09') THEN faturamento_total ELSE faturamento_total + 1 END "
        "AS faturamento_total) FROM faturamento WHERE mes_ano <> '2000-08'")
    q["dedup_best_row_agg"] = q["dedup_best_row"]
    q["recode_map_table"] = W(
        f"SELECT s._linha, s.status, s.status_padrao, o.cliente_id, coalesce(c.estado, 'N/D') AS estado_cliente "
        f"FROM ({STATUS_SQL}) s JOIN dirty_orders o ON o._linha = s._linha "
        f"LEFT JOIN stg_clientes c ON c.cliente_id = TRY_CAST(TRY_CAST(o.cliente_id AS DOUBLE) AS BIGINT)")
    q["medallion_end_to_end"] = W("SELECT * FROM faturamento")
    q["medallion_dq_report"] = W(_dq_sql(DQ_TESTS))
    q["medallion_lenient_end_to_end"] = W(D_GOLD)
    return q
