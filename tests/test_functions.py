"""Edge-case literals of the column expressions (FIXTURES section 4)."""

import datetime as dt
from decimal import Decimal

from conftest import one_col
from pyspark.sql import functions as F

from strata.functions import dates, numbers, recode, text


def _eval(spark, values, expr):
    df = one_col(spark, values).withColumn("__i", F.monotonically_increasing_id())
    rows = df.select("__i", expr(F.col("c")).alias("r")).orderBy("__i").collect()
    return [r["r"] for r in rows]


def test_tolerant_date_accepts(spark):
    vals = ["2023-06-01", "2023/06/11", "2023-6-1", " 2023-01-15 ", "2023-01-15 10:00:00",
            "2023-01-15T10:00:00", "15/01/2023 10:00:00", "13/07/2023"]
    got = _eval(spark, vals, dates.parse_date_multi)
    assert got == [dt.date(2023, 6, 1), dt.date(2023, 6, 11), dt.date(2023, 6, 1), dt.date(2023, 1, 15),
                   dt.date(2023, 1, 15), dt.date(2023, 1, 15), dt.date(2023, 1, 15), dt.date(2023, 7, 13)]


def test_tolerant_date_rejects(spark):
    vals = ["2023-06-89", "2023-45-04", "2023-02-29", "2023", "2023-06", "", None, "2023/06-11", "abc"]
    assert _eval(spark, vals, dates.parse_date_multi) == [None] * len(vals)


def test_range_clamp(spark):
    vals = ["2923-06-22", "1999-12-31", "2000-01-01", "2025-12-31", "2026-01-02"]
    got = _eval(spark, vals, lambda c: dates.clamp_date(dates.parse_date_multi(c), as_of="2026-01-01"))
    assert got == [None, None, dt.date(2000, 1, 1), dt.date(2025, 12, 31), None]


def test_parse_brl_literal(spark):
    vals = ["R$ 150,5", "R$ 1.200,00", "R$ 46.284,00", "R$ 53,805", "R$  -5,5", "1e3", "30.0",
            "", "abc", "r$ 5,00", "12345678901,00", None]
    got = _eval(spark, vals, lambda c: numbers.parse_brl(c, "literal"))
    assert got == [Decimal("150.50"), Decimal("1200.00"), Decimal("46284.00"), Decimal("53.81"), Decimal("-5.50"),
                   Decimal("1000.00"), Decimal("300.00")] + [Decimal("0.00")] * 5


def test_parse_brl_auto(spark):
    got = _eval(spark, ["30.0", "R$ 1.200,00", "12,5", "abc"], lambda c: numbers.parse_brl(c, "auto"))
    assert got == [Decimal("30.00"), Decimal("1200.00"), Decimal("12.50"), Decimal("0.00")]


def test_tolerant_int(spark):
    got = _eval(spark, ["101", "101.0", "101.5", "1e2", " 7 ", "x", None], lambda c: numbers.to_int_tolerant(c, "int"))
    assert got == [101, 101, 102, 100, 7, None, None]


def test_coerce_zero(spark):
    got = _eval(spark, ["30.0", "R$ 1,00", None, " 2.5 ", "NaN"], numbers.coerce_double_zero)
    assert got == [30.0, 0.0, 0.0, 2.5, 0.0]


def test_title_words(spark):
    vals = ["joao da silva", "  MARIA  OLIVEIRA ", "o'neil", "maria-jose souza", "élio ávila"]
    want = ["Joao Da Silva", "Maria  Oliveira", "O'neil", "Maria-jose Souza", "Élio Ávila"]
    assert _eval(spark, vals, text.title_words) == want
    assert _eval(spark, vals, text.title_words_explicit) == want


def test_title_letters(spark):
    vals = ["o'neil", "maria-jose", " 2x y", None]
    got = _eval(spark, vals, lambda c: text.title_letters(text.strip_ws(c)))
    assert got == ["O'Neil", "Maria-Jose", "2X Y", None]
    assert [v.title() for v in vals[:3]] == ["O'Neil", "Maria-Jose", " 2X Y"]


def test_single_format_coerce(spark):
    got = _eval(spark, ["01/06/2023", "13/07/2023", "2023-01-01"], lambda c: dates.parse_date_coerce(c, "MM/dd/yyyy"))
    assert got == [dt.date(2023, 1, 6), None, None]


def test_strict_date(spark):
    got = _eval(spark, ["07/06/2023", "2023-06-08", None], dates.parse_date_strict)
    assert got == ["2023-06-07", "2023-06-08", None]


def test_strict_date_raises(spark):
    import pytest
    with pytest.raises(Exception):
        _eval(spark, ["31/02/2023"], dates.parse_date_strict)


def test_month_texts(spark):
    got = _eval(spark, ["2023-06-01", None], lambda c: dates.month_text_nat(dates.parse_date_multi(c)))
    assert got == ["2023-06", "NaT"]


def test_recode_profiles(spark):
    assert _eval(spark, ["são paulo ", "RIO DE JANEIRO", "ba", None], recode.recode_state) == ["SP", "RJ", "BA", None]
    assert _eval(spark, ["concluido", " pendentte", "PENDEDNTE"], recode.recode_status) == \
        ["CONCLUÍDO", "PENDENTE", "PENDEDNTE"]
    assert _eval(spark, [" PIX", "Cartão de Crédito", " Ted "], recode.recode_method) == ["PIX", "Cartão de Crédito", "Ted"]
    assert _eval(spark, ["pendente", "CONCLUIDO", None],
                 lambda c: recode.recode_default(c, recode.STATUS_A, "INDEFINIDO")) == \
        ["INDEFINIDO", "CONCLUÍDO", "INDEFINIDO"]
    assert _eval(spark, ["Boleto", "boleto"], lambda c: recode.lookup(c, recode.METHOD_A)) == ["Boleto", None]


def test_email_defaults(spark):
    vals = [" A@B.COM ", None, ""]
    assert _eval(spark, vals, text.email_normalized) == ["a@b.com", "nao_informado@email.com", ""]
    assert _eval(spark, vals, text.email_lower_fill) == [" a@b.com ", "nao_informado@email.com", ""]
    assert _eval(spark, vals, text.email_fill) == [" A@B.COM ", "nao_informado@email.com", ""]
