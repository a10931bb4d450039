"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, table_path

def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "documents"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "pages"))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts the lineage; a
    lost executor costs only the tasks that were running on it)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def even_parts(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def texts_of(column: pa.Array) -> Iterator[str]:
    """Python strings of an Arrow text column, one at a time; null is empty."""
    for value in column:
        yield value.as_py() or ""


def tidy(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``, giving memory back to the system when a task ends: Python workers are
    used again by later tasks, and what one task needed for a moment would stay with them."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
            if trim is not None:
                trim(0)

    return wrapped


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (multiply, shift, xor)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHashes(dict):
    """64-bit hash of a word (bytes), remembered between calls up to a bound."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; the whole sequence as one if it is
    shorter (another hash family, so it never equals a full run); empty if
    there is no word."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    if n < size:
        h = np.uint64(n)
        for w in words:
            h = mix64((np.array([h], np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ w)[0]
        return np.array([h], np.uint64)
    h = words[: n - size + 1].copy()
    for k in range(1, size):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[k: n - size + 1 + k]
    return mix64(h)


#: Nodes with more edges than this can be hubs (see ``components``).
HUB = 64


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    ``edges(a, b)``: pairs of long ids; direction and repeats don't matter,
    loops and nulls are ignored. Returns ``(node, component)`` for each node of
    an edge, ``component`` the smallest id reachable. Every step is a grouped
    minimum (combined before the shuffle) and an equi-join; each result is
    written to the shared folder, so the lineage stays short. So are the minima
    and the pairs between the two steps: what is used several times would else
    stand as often in each plan, and the driver keeps the plans, their compiled
    code and one broadcast for each. The steps end when no node is above two
    others, or above one and below another: then all pairs are stars. Hubs,
    nodes with more than 1/10,000 of the edges (64 at least), are joined by
    broadcast: E edges have at most 2 E / (E / 10,000) = 20,000 of them, and no
    key that is shuffled has more rows than that share. Nothing else is sent
    through the driver, however much the session lets it broadcast.
    """
    pair = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .distinct(), name)

    def counted(df):
        """Number of pairs, and of nodes above two others or in the middle."""
        ends = (df.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
                .unionByName(df.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
                .groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")))
        row = ends.agg(F.sum("up"), F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()
        return row[0], row[1]

    while True:
        n, loose = counted(pair)
        if not loose:
            break
        # large star: every larger neighbour is tied to the smallest of the node and its neighbours
        both = pair.select("u", "v").unionByName(pair.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("degree")).select(
            "u", F.least("u", "m").alias("m"), (F.col("degree") > max(HUB, n // 10_000)).alias("hub")), f"{name}-least")
        hubs = least.where("hub").select("u", F.col("m").alias("of_hub"))
        larger = both.where("v > u").join(F.broadcast(hubs), "u", "left")
        tied = (larger.where("of_hub is not null").select("v", F.col("of_hub").alias("m"))
                .unionByName(larger.where("of_hub is null").join(least.where("not hub").hint("merge"), "u").select("v", "m")))
        large = staged(tied.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), f"{name}-large")
        # small star: the smaller neighbours and the node itself are tied to the smallest neighbour
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.withColumnRenamed("m", "v")).where("u <> v").distinct())
        pair = staged(small, name)
    return (pair.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
            .unionByName(pair.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
