"""Referential integrity operators (JN1, JN2, JN8, JN9).

Joins are declared as equi-joins and the physical strategy is left to
the planner: AQE turns them into broadcast joins when the runtime size
of the parent side is below ``spark.sql.adaptive.autoBroadcastJoinThreshold``
(a measured bound), otherwise they stay sort-merge joins, with AQE
splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _key(df: DataFrame, k) -> Column:
    return df[k] if isinstance(k, str) else k


def fk_filter(child: DataFrame, parent: DataFrame, child_key, parent_key: str, how: str = "semi") -> DataFrame:
    """JN1/JN2: keep child rows whose key exists in the parent.

    ``how='semi'`` returns each child row once (the parent key is only a
    filter). ``how='inner'`` keeps the inner-join multiplicity (one output
    row per matching parent row), the reference's behaviour when the parent
    key is not unique.
    """
    ck = _key(child, child_key)
    if how == "semi":
        pk = parent.select(F.col(parent_key).alias("__pk"))
        return child.join(pk, ck == F.col("__pk"), "left_semi")
    if how == "inner":
        # The output *is* one row per (child row, matching parent row), so the
        # join is kept plain: both inputs then come straight from a shuffle and
        # AQE can split a hot key on either side (a pre-aggregated parent side
        # would make the join ineligible for skew splitting).
        pk = parent.select(F.col(parent_key).alias("__pk"))
        return child.join(pk, ck == F.col("__pk"), "inner").drop("__pk")
    raise ValueError(how)


def orphans(child: DataFrame, parent: DataFrame, child_key, parent_key: str,
            null_safe: bool = True) -> DataFrame:
    """JN8: child rows whose key is absent from the parent (left anti).

    ``null_safe=True`` follows pandas ``~isin``: a NULL child key is an
    orphan unless the parent has a NULL key too."""
    pk = parent.select(F.col(parent_key).alias("__pk"))
    ck = _key(child, child_key)
    cond = ck.eqNullSafe(F.col("__pk")) if null_safe else (ck == F.col("__pk"))
    return child.join(pk, cond, "left_anti")


def missing_parents(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """JN9: non-NULL child keys without a parent row (dbt ``relationships``)."""
    c = child.where(F.col(child_key).isNotNull())
    return orphans(c, parent, child_key, parent_key, null_safe=False)
