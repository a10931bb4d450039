"""Recoding from a table (RC1 for maps that are data, not literals)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, NULL = "keep", "null"


def map_of(table: DataFrame, key: str, value: str, on_repeat: str = "raise") -> DataFrame:
    """``(map_key, map_value)`` of a mapping table, one row per key; rows with a null key go.

    A key in several rows raises, whatever their values, with ``on_repeat="raise"``; ``"least"`` takes its
    smallest value (a null only if it has no other)."""
    if on_repeat not in ("raise", "least"):
        raise ValueError(f"on_repeat: {on_repeat}")
    rows = table.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("map_key")) \
        .agg(F.min(value).alias("map_value"), F.count(F.lit(1)).alias("n"))
    if on_repeat == "raise":
        message = F.concat(F.lit(f"{key} repeats in the map: "), F.col("map_key").cast("string"))
        rows = rows.withColumn("map_value", F.when(F.col("n") > 1, F.raise_error(message).cast(rows.schema["map_value"].dataType))
                               .otherwise(F.col("map_value")))
    return rows.select("map_key", "map_value")


def recode_from_table(df: DataFrame, column: str | Column, into: str, table: DataFrame, key: str, value: str,
                      unknown: str | Column = KEEP, on_repeat: str = "raise") -> DataFrame:
    """RC1 with the map as a table: ``df`` with ``into``, the value that ``table`` has for ``column``.

    ``column`` may be an expression (a normalised text). What the map lacks, and a null, keeps the looked-up text
    (``KEEP``), becomes NULL (``NULL``) or takes the given Column. A key that the map has with a null value is
    known: its value is NULL. The join is not forced: adaptive execution broadcasts a map that it has measured to be
    small, and otherwise joins by key and splits one that holds much of ``df``; rows with a null key meet no map row.
    Every map row is read, so a repeated key raises even if ``df`` never asks for it.
    """
    names = [c for c in df.columns if c != into]
    looked = F.col(column) if isinstance(column, str) else column
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), looked.alias("asked"))
    found = rows.join(map_of(table, key, value, on_repeat).withColumn("known", F.lit(True)),
                      F.col("asked") == F.col("map_key"), "left")
    other = {KEEP: F.col("asked"), NULL: F.lit(None)}.get(unknown, unknown) if isinstance(unknown, str) else unknown
    return found.select("row.*", F.when(F.col("known"), F.col("map_value")).otherwise(other).alias(into))
