"""Value recoding (RC1-RC6) with literal maps kept JVM-side.

Small maps become a literal ``map`` and one ``try_element_at`` lookup
(inside whole-stage codegen). A large map is a table: left-join it and let
adaptive execution measure its size.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (they must equal the reference's outputs).
# Profile S: upper/trimmed state names -> UF code.
STATE_LONG_TO_CODE = {
    "SÃO PAULO": "SP",
    "RIO DE JANEIRO": "RJ",
    "MINAS GERAIS": "MG",
    "PARANÁ": "PR",
    "RIO GRANDE DO SUL": "RS",
}
# Profile S: upper/trimmed order status -> canonical status.
STATUS_S = {
    "CONCLUIDO": "CONCLUÍDO",
    "PENDENTTE": "PENDENTE",
    "CANCELADO": "CANCELADO",
}
# Profile S: lower/trimmed payment method -> canonical label.
METHOD_S = {
    "cartao_credito": "Cartão de Crédito",
    "cartão de crédito": "Cartão de Crédito",
    "pix": "PIX",
    "boleto": "Boleto",
}
# Profile D: status replacement after upper-casing.
STATUS_D_REPLACE = {"PENDENTTE": "PENDENTE"}
# Profile A: exact-key maps (no normalisation before lookup).
STATE_A = {"São Paulo": "SP", "SP": "SP", "RJ": "RJ", "MG": "MG", "PR": "PR", "RS": "RS"}
STATUS_A = {
    "CONCLUIDO": "CONCLUÍDO",
    "concluido": "CONCLUÍDO",
    "pendentte": "PENDENTE",
    "CANCELADO": "CANCELADO",
}
STATUS_A_DEFAULT = "INDEFINIDO"
METHOD_A = {
    "cartao_credito": "Cartão de Crédito",
    "Cartão de Crédito": "Cartão de Crédito",
    "PIX": "PIX",
    "pix": "PIX",
    "Boleto": "Boleto",
}
# Completed-status literal per profile, and the declared accepted set.
COMPLETED_S = "CONCLUÍDO"
COMPLETED_D = "CONCLUIDO"
ACCEPTED_STATUS_DECLARED = ("CONCLUIDO", "PENDENTE", "CANCELADO")
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(mapping: dict) -> Column:
    args = []
    for k, v in mapping.items():
        args += [F.lit(k), F.lit(v)]
    return F.create_map(*args)


def lookup(c, mapping: dict) -> Column:
    """Exact lookup; NULL when the key is absent (RC5)."""
    return F.try_element_at(literal_map(mapping), _c(c))


def recode_keep(c, mapping: dict) -> Column:
    """RC3: exact-key map, unknown keeps the input."""
    return F.coalesce(lookup(c, mapping), _c(c))


def recode_default(c, mapping: dict, default: str) -> Column:
    """RC4: exact-key map, unknown (and NULL) -> constant."""
    return F.coalesce(lookup(c, mapping), F.lit(default))


def recode_normalized(c, mapping: dict, normalize) -> Column:
    """RC1: look up the normalised text; unknown -> the normalised text."""
    n = normalize(_c(c))
    return F.coalesce(lookup(n, mapping), n)


def recode_state(c) -> Column:
    return recode_normalized(c, STATE_LONG_TO_CODE, lambda x: F.upper(F.trim(x)))


def recode_status(c) -> Column:
    return recode_normalized(c, STATUS_S, lambda x: F.upper(F.trim(x)))


def recode_method(c) -> Column:
    """RC2: key = lower(trim(raw)); unknown -> trim(raw) (case kept)."""
    return F.coalesce(lookup(F.lower(F.trim(_c(c))), METHOD_S), F.trim(_c(c)))


def recode_status_lenient(c) -> Column:
    """RC6: upper then value replacement."""
    return recode_keep(F.upper(_c(c)), STATUS_D_REPLACE)
