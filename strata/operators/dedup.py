"""Deduplication operators (WIN1, FIL3, SET1-SET3).

All of them reduce rows *before* the shuffle: ``row_number() == 1``
becomes a partial ``WindowGroupLimit`` on the map side, and
``distinct``/``dropDuplicates`` are partial hash aggregates. A key that
holds a third of all rows is therefore cut to one row per map partition
before it is exchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def best_row_per_key(df: DataFrame, key, order: Sequence, keep_null_key: bool = False) -> DataFrame:
    """WIN1 + FIL3: keep the first row per ``key`` under ``order``.

    ``order`` is a list of sort Columns (e.g. ``[F.col('d').asc_nulls_last(),
    F.col('_linha').asc()]``); give a unique tie-break as the last entry
    so the result is deterministic.
    """
    key_c = F.col(key) if isinstance(key, str) else key
    w = Window.partitionBy(key_c).orderBy(*_cols(order))
    out = df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")
    if not keep_null_key:
        out = out.where(key_c.isNotNull())
    return out


def best_row_aggregate(df: DataFrame, key: str, order: Sequence[tuple[str, bool]], keep_null_key: bool = False) -> DataFrame:
    """WIN1 as an aggregate: the row with the least ``order`` per ``key``, as ``best_row_per_key`` keeps it.

    ``order`` lists ``(column, ascending)``, missing values last either way; descending columns must be numbers
    or dates. ``min_by`` holds one row per key and task before the shuffle, so a key with a third of the rows sends a
    row per map task and its rows are never brought together or sorted by ``order``."""
    def rank(column: str, ascending: bool) -> list[Column]:
        c = F.col(column)
        if not ascending:
            c = -F.unix_date(c) if dict(df.dtypes)[column] == "date" else -c
        return [c.isNull(), c]

    least = F.struct(*[x.alias(f"o{i}_{j}") for i, (c, a) in enumerate(order) for j, x in enumerate(rank(c, a))])
    rows = df if keep_null_key else df.where(F.col(key).isNotNull())
    best = rows.groupBy(F.col(key).alias("k")).agg(F.min_by(F.struct(*[F.col(c) for c in df.columns]), least).alias("best"))
    return best.select("best.*")


def first_by_key(df: DataFrame, key: str, ordinal: Sequence[str] = ("_linha",),
                 drop_null_key: bool = True) -> DataFrame:
    """SET3 (pandas ``drop_duplicates(subset=key)``): first row in file
    order per key. ``ordinal`` columns give file order (ascending)."""
    if drop_null_key:
        df = df.where(F.col(key).isNotNull())
    order = [F.col(c).asc_nulls_first() for c in ordinal]
    return best_row_per_key(df, key, order, keep_null_key=not drop_null_key)


def distinct_rows(df: DataFrame, business_columns: Sequence[str] | None = None) -> DataFrame:
    """SET1/SET2: full-row distinct over the business columns (metadata
    columns such as ``_ingerido_em`` and ``_linha`` are excluded, so rows
    re-landed by a later batch still collapse)."""
    cols = list(business_columns) if business_columns else [c for c in df.columns if not c.startswith("_")]
    return df.select(*cols).distinct()
