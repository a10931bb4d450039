"""Text normalisation as native Column expressions (STR1-STR9, RC7)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default e-mail for missing addresses.
DEFAULT_EMAIL = "nao_informado@email.com"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """STR1 (pandas ``str.strip``): remove leading/trailing whitespace of
    any kind, not only spaces."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def norm_upper(c) -> Column:
    return F.upper(F.trim(_c(c)))


def norm_lower(c) -> Column:
    return F.lower(F.trim(_c(c)))


def title_words(c) -> Column:
    """STR3: trim, lower, capitalise the first letter after each single
    space; repeated spaces are kept."""
    return F.initcap(F.lower(F.trim(_c(c))))


def title_words_explicit(c) -> Column:
    """STR5-STR9 spelled out: split on ' ', upper first char + rest, join."""
    words = F.split(F.lower(F.trim(_c(c))), " ")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), " ")


def title_letters(c) -> Column:
    """STR4 (Python ``str.title``): capital after every non-letter
    (``o'neil`` -> ``O'Neil``, ``2x`` -> ``2X``)."""
    runs = F.regexp_extract_all(_c(c), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.when(_c(c).isNotNull(), F.array_join(F.transform(runs, lambda r: F.initcap(r)), ""))


def email_normalized(c, default: str = DEFAULT_EMAIL) -> Column:
    """RC7 (profile S): lower/trim; NULL -> default (empty text is kept)."""
    return F.coalesce(F.lower(F.trim(_c(c))), F.lit(default))


def email_lower_fill(c, default: str = DEFAULT_EMAIL) -> Column:
    """RC7 (profile D): lower without trim; NULL -> default."""
    return F.coalesce(F.lower(_c(c)), F.lit(default))


def email_fill(c, default: str = DEFAULT_EMAIL) -> Column:
    """RC7 (profile A): only fill NULLs."""
    return F.coalesce(_c(c), F.lit(default))
