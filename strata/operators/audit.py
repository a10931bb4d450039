"""Diagnostic audit operators (DQ6, DQ8, AG11-AG14).

Each returns a small findings DataFrame computed with aggregations only;
no rows are pulled to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .integrity import orphans


def null_counts(df: DataFrame, table: str, columns: Sequence[str] | None = None,
                only_positive: bool = True) -> DataFrame:
    """AG11 + FIL8: NULL count per column in one pass, unpivoted to
    ``(tabela, coluna, nulos)``; optionally only columns with NULLs."""
    cols = list(columns) if columns else [c for c in df.columns if not c.startswith("_")]
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', c{i}" for i, c in enumerate(cols))
    out = wide.selectExpr(f"stack({len(cols)}, {stack}) as (coluna, nulos)") \
        .select(F.lit(table).alias("tabela"), "coluna", F.col("nulos").cast("bigint").alias("nulos"))
    return out.where(F.col("nulos") > 0) if only_positive else out


def duplicate_keys(df: DataFrame, table: str, key: str) -> DataFrame:
    """AG12 (pandas ``duplicated`` on one column): rows beyond the first
    per key value, NULL counted as one value."""
    k = F.col(key)
    out = df.agg((F.count(F.lit(1)) - F.count_distinct(k)
                  - F.when(F.count_if(k.isNull()) > 0, 1).otherwise(0)).alias("duplicadas"))
    return out.select(F.lit(table).alias("tabela"), F.lit(key).alias("coluna"),
                      F.col("duplicadas").cast("bigint").alias("duplicadas"))


def duplicate_rows(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """AG13: fully identical rows beyond the first (NULLs equal).
    ``groupBy(all columns)`` is a partial aggregation, so a heavily
    repeated row is collapsed on the map side."""
    cols = list(columns) if columns else [c for c in df.columns if not c.startswith("_")]
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicadas")) \
        .select(F.lit(table).alias("tabela"), "duplicadas")


def orphan_rows(child: DataFrame, parent: DataFrame, child_key, parent_key: str,
                columns: Sequence[str]) -> DataFrame:
    """DQ8 + JN8 + PRJ4: listing of orphan child rows."""
    return orphans(child, parent, child_key, parent_key, null_safe=True).select(*columns)


def orphan_count(child: DataFrame, parent: DataFrame, child_key, parent_key: str, table: str) -> DataFrame:
    """AG14: number of orphan child rows. Rows are counted per key before the
    join, so a hot or NULL key is one row there."""
    keys = child.groupBy(child[child_key].alias("__k") if isinstance(child_key, str) else child_key.alias("__k")).agg(
        F.count(F.lit(1)).alias("__n"))
    o = orphans(keys, parent.select(parent_key).distinct(), "__k", parent_key, null_safe=True)
    return o.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("orfaos")).select(F.lit(table).alias("tabela"), "orfaos")


def table_profile(df: DataFrame, table: str, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """AG11 + AG12 + AG13 for one table from a single scan.

    One ``groupBy(all columns).count()`` (map-side partial aggregation, so
    repeated rows and hot keys collapse before the shuffle) yields
    everything: duplicate rows are ``sum(n - 1)``, the NULL count of a
    column is ``sum(n)`` over groups where it is NULL, and the distinct key
    values are unchanged by the grouping. Returns the findings in the
    report layout ``(secao, tabela, coluna, valor)``."""
    cols = list(columns) if columns else [c for c in df.columns if not c.startswith("_")]
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    n = F.col("__n")
    k = F.col(key)
    aggs = [F.coalesce(F.sum(F.when(F.col(c).isNull(), n)), F.lit(0)).alias(f"c{i}") for i, c in enumerate(cols)]
    aggs += [F.coalesce(F.sum(n - 1), F.lit(0)).alias("dup_rows"),
             (F.coalesce(F.sum(n), F.lit(0)) - F.count_distinct(k)
              - F.when(F.max(k.isNull().cast("int")) > 0, 1).otherwise(0)).alias("dup_keys")]
    wide = g.agg(*aggs)
    entries = [f"'nulos', '{c}', c{i}" for i, c in enumerate(cols)]
    entries += [f"'chaves_duplicadas', '{key}', dup_keys", "'linhas_duplicadas', CAST(NULL AS STRING), dup_rows"]
    long = wide.selectExpr(f"stack({len(entries)}, {', '.join(entries)}) as (secao, coluna, valor)")
    keep = (F.col("secao") != "nulos") | (F.col("valor") > 0)
    return long.where(keep).select("secao", F.lit(table).alias("tabela"), "coluna",
                                   F.col("valor").cast("bigint").alias("valor"))


def audit_report_profiled(tables: dict[str, tuple[DataFrame, str]], orphan_parts: list[DataFrame]) -> DataFrame:
    """DQ6: one long findings table ``(secao, tabela, coluna, valor)`` from one
    profiling scan per table (:func:`table_profile`) and the orphan counts,
    which scan the key columns of child and parent."""
    parts = [table_profile(df, t, key) for t, (df, key) in tables.items()]
    parts += [p.select(F.lit("orfaos").alias("secao"), "tabela", F.lit(None).cast("string").alias("coluna"),
                       F.col("orfaos").cast("bigint").alias("valor")) for p in orphan_parts]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
