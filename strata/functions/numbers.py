"""Money and number parsing as native Column expressions (NUM1-NUM8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_TYPE = "decimal(10,2)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _ptbr_rule(c: Column) -> Column:
    # drop the currency sign and thousands dots, decimal comma -> dot
    return F.replace(F.replace(F.replace(c, F.lit("R$"), F.lit("")), F.lit("."), F.lit("")), F.lit(","), F.lit("."))


def parse_brl(c, mode: str = "literal", dtype: str = MONEY_TYPE) -> Column:
    """NUM1: pt-BR money text -> decimal; NULL, junk or overflow -> 0.00.

    ``mode='literal'`` always applies the pt-BR rule (so ``30.0`` reads as
    300.00, the reference's behaviour); ``mode='auto'`` applies it only when
    the text has ``R$`` or ``,`` and otherwise reads a plain decimal.
    """
    c = _c(c).cast("string")
    if mode == "literal":
        parsed = _ptbr_rule(c).try_cast(dtype)
    elif mode == "auto":
        parsed = F.when(c.contains("R$") | c.contains(","), _ptbr_rule(c).try_cast(dtype)) \
            .otherwise(F.trim(c).try_cast(dtype))
    else:
        raise ValueError(f"unknown money mode {mode!r}")
    return F.coalesce(parsed, F.lit(0).cast(dtype))


def coerce_double_zero(c) -> Column:
    """NUM2: numeric coerce; NULL, junk and NaN -> 0.0."""
    v = F.trim(_c(c).cast("string")).try_cast("double")
    return F.when(F.isnan(v), F.lit(0.0)).otherwise(F.coalesce(v, F.lit(0.0)))


def to_int_tolerant(c, dtype: str = "bigint") -> Column:
    """NUM3: tolerant integer cast: ``101.0``->101, ``101.5``->102 (half up),
    ``1e2``->100, `` 7 ``->7, junk -> NULL."""
    return F.round(_c(c).cast("string").try_cast("decimal(38,10)")).try_cast(dtype)


def to_int_strict(c, dtype: str = "int") -> Column:
    """NUM4: reads what :func:`to_int_tolerant` reads (``101.0``, ``101.5``, ``1e2``)
    and raises on any other text, whatever the session's ANSI flag; NULL stays NULL."""
    c = _c(c).cast("string")
    v = to_int_tolerant(c, dtype)
    bad = F.raise_error(F.concat(F.lit("not an integer: "), c)).cast(dtype)
    return F.when(c.isNull() | v.isNotNull(), v).otherwise(bad)


def fmt_brl_display(c) -> Column:
    """NUM8: ``R$ 1,234.56`` display text."""
    return F.concat(F.lit("R$ "), F.format_number(_c(c).cast("double"), 2))


def fmt_int_display(c) -> Column:
    """NUM8: integer with thousands separators."""
    return F.format_number(_c(c).cast("bigint"), 0)


def fmt_pct_display(c) -> Column:
    """NUM8: ``12.3%`` label of a percentage value (half up)."""
    return F.concat(F.format_number(F.round(_c(c).cast("double"), 1), 1), F.lit("%"))
