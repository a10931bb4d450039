"""Layer writers (SNK1, SNK3, SNK4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.dates import ingest_timestamp_text

INGEST_COLUMN = "_ingerido_em"


def add_ingest_meta(df: DataFrame, column: str = INGEST_COLUMN) -> DataFrame:
    """SNK1/PRJ5: constant-per-batch UTC ingest instant as ISO text."""
    return df.withColumn(column, ingest_timestamp_text())


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """SNK4: attach a row counter that is filled by the next action on
    ``df`` (no extra pass over the data)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("linhas")), obs


def write_layer(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, mode: str = "overwrite",
                fmt: str = "parquet", keep_other_partitions: bool = False) -> None:
    """SNK3: write a model's result to a fixed location.

    With ``partition_by`` the rows are first rebalanced on the partition
    columns: adaptive execution measures what each value has, gives a busy
    month to as many tasks as its bytes need (``advisoryPartitionSizeInBytes``
    each) and puts small ones together, so neither one task writes a month of
    any size nor every task into every directory. The whole table is replaced,
    so a partition that is no longer in the result goes;
    ``keep_other_partitions`` replaces only those that ``df`` has (see
    ``replace_partitions``)."""
    w = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    writer = w.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option(
            "partitionOverwriteMode", "dynamic" if keep_other_partitions else "static")
    writer.save(path)


def replace_partitions(df: DataFrame, path: str, column: str, values: Sequence[str]) -> None:
    """SNK3, partition-wise: of the table at ``path``, partitioned by the text ``column``, replace exactly
    the partitions ``values``; a named one without rows in ``df`` ends up empty, all others stay as they
    are. Rows of ``df`` under other values raise before anything is written to their partitions."""
    named = F.col(column).isin(list(values))
    stray = F.raise_error(F.concat(F.lit(f"not a named {column}: "), F.coalesce(F.col(column).cast("string"), F.lit("NULL"))))
    checked = df.withColumn(column, F.when(named, F.col(column)).otherwise(stray.cast("string")))
    part, obs = checked, Observation()
    part = part.observe(obs, F.collect_set(column).alias("found"))  # at most as many as are named
    write_layer(part, path, [column], keep_other_partitions=True)
    nothing = df.sparkSession.createDataFrame([], df.drop(column).schema)
    for value in sorted(set(values) - set(obs.get["found"])):
        nothing.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{column}={value}")


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once (Parquet) and return the read-back table.

    Used where one model feeds several consumers: they then scan the
    written files instead of each recomputing the model, and the lineage is
    cut (a lost executor re-reads the files, it does not recompute)."""
    write_layer(df, path)
    return df.sparkSession.read.parquet(path)
