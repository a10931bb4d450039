"""Date parsing and formatting as native Column expressions (DT1-DT9).

All parsers are total: anything they cannot read becomes NULL (``try_*``),
except :func:`parse_date_strict`, which keeps the strict "raise on bad
input" contract of the audit profile.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The plausible business date range starts here.
DATE_FLOOR = "2000-01-01"

# Formats tried after the ISO form, in order (DT1).
DMY = "d/M/yyyy"
YMD_HMS = "yyyy-M-d H:m:s"
DMY_HMS = "d/M/yyyy H:m:s"
MULTI_FORMATS = (DMY, YMD_HMS, DMY_HMS)

_ISO_SHAPE = r"^\d{4}([-/])\d{1,2}\1\d{1,2}($|[ T]\d)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_date(c) -> Column:
    """Tolerant ISO date: ``Y-m-d`` or ``Y/m/d``, 1-2 digit month/day,
    optional time tail after a space or ``T``; anything else NULL."""
    t = F.trim(_c(c))
    # the shape test fixes the layout, so '/' -> '-' is a plain character
    # map (the cast ignores anything after the date part)
    return F.when(t.rlike(_ISO_SHAPE), F.translate(t, "/", "-").try_cast("date"))


def format_shape(fmt: str) -> str | None:
    """A regex accepting a superset of the texts ``fmt`` can parse, or
    None for patterns it does not understand. Used as a cheap guard: the
    pattern parsers signal a mismatch with an exception, which costs far
    more per row than a compiled regex test."""
    out = ["^"]
    for m in re.finditer(r"(.)\1*", fmt):
        run, ch = m.group(0), m.group(1)
        if ch == "y":
            out.append(r"\d+")
        elif ch in "dMHms" and len(run) <= 2:
            out.append(r"\d{1,2}")
        elif ch.isalpha() or ch == "'":
            return None
        else:
            out.append(re.escape(run))
    out.append("$")
    return "".join(out)


def _try_format(c: Column, fmt: str) -> Column:
    if any(ch in fmt for ch in "Hms"):
        parsed = F.to_date(F.try_to_timestamp(c, F.lit(fmt)))
    else:
        parsed = F.try_to_date(c, fmt)
    shape = format_shape(fmt)
    return F.when(c.rlike(shape), parsed) if shape else parsed


def parse_date_multi(c, formats=MULTI_FORMATS) -> Column:
    """DT1/DT2: ISO first, then each format in order; first hit wins.
    Each parser is guarded by its shape regex, so a text is parsed only by
    the parser whose layout it has."""
    t = F.trim(_c(c))
    return F.coalesce(iso_date(t), *[_try_format(t, f) for f in formats])


def clamp_date(d, lo: str = DATE_FLOOR, as_of=None) -> Column:
    """DT3: keep dates within ``[lo, as_of]`` else NULL.

    ``as_of`` is a ``'yyyy-MM-dd'`` string, a ``date`` or a Column; the
    default is ``current_date()`` (constant per query)."""
    d = _c(d)
    if as_of is None:
        hi = F.current_date()
    elif isinstance(as_of, Column):
        hi = as_of
    else:
        hi = F.lit(str(as_of)).cast("date") if not isinstance(as_of, _dt.date) else F.lit(as_of)
    return F.when((d < F.lit(lo).cast("date")) | (d > hi), F.lit(None).cast("date")).otherwise(d)


def parse_date_strict(c) -> Column:
    """DT4: ``d/m/Y`` when the text has a ``/`` else ``Y-m-d``; raises on
    bad input (ANSI ``to_date``); NULL stays NULL; output text ``yyyy-MM-dd``."""
    c = _c(c)
    d = F.when(c.contains("/"), F.to_date(c, "dd/MM/yyyy")).otherwise(F.to_date(c, "yyyy-MM-dd"))
    return F.date_format(d, "yyyy-MM-dd")


# First and last calendar day a pandas ``datetime64[ns]``
# can hold; the lenient profile turns dates outside it into NaT (NULL).
PANDAS_MIN_DATE = "1677-09-22"
PANDAS_MAX_DATE = "2262-04-11"


def parse_date_coerce(c, fmt: str = "yyyy-MM-dd",
                      bounds: tuple[str, str] | None = (PANDAS_MIN_DATE, PANDAS_MAX_DATE)) -> Column:
    """DT5: one fixed format; everything else NULL, dates outside ``bounds``
    (both ends included; None: no bounds) too."""
    d = _try_format(F.trim(_c(c)), fmt)
    if bounds:
        lo, hi = bounds
        d = F.when(d.between(F.lit(lo).cast("date"), F.lit(hi).cast("date")), d)
    return d


def month_text(d) -> Column:
    """DT6: ``yyyy-MM`` of a date; NULL stays NULL."""
    return F.date_format(_c(d), "yyyy-MM")


def month_text_nat(d) -> Column:
    """DT7: like :func:`month_text` but a missing date gives the text ``NaT``."""
    return F.coalesce(month_text(d), F.lit("NaT"))


def ingest_timestamp_text() -> Column:
    """DT9: UTC ingest instant as ISO-8601 text, constant within one query."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
