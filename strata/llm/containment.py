"""Benchmark decontamination: MinHash containment search, size partitioned.

Test items are short and documents long, so the Jaccard similarity of the two
is tiny although the item may be wholly inside. The search therefore samples
the item only: under one random order of hashes, its smallest shingles are a
sample without replacement, and each is in the document with probability equal
to the containment. Items are partitioned by size, and each partition has its
own sample size: the smallest that no item at the threshold can miss (of n
shingles at most ``n - ceil(t n)`` are absent, so one more sample than that
must hit), which short items keep small. A document's own shingles are streamed against
the samples; the pairs that hit are verified on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mix64, shingle_hashes, texts_of, tidy, WordHashes

_FOUND = pa.struct([("item_id", pa.int64()), ("n_item", pa.int64()), ("n_shared", pa.int64())])


@dataclass
class ItemIndex:
    """Samples and full sets of one block of items."""

    ids: list
    sets: list[np.ndarray]
    percent: int
    sizes: list[int]  # shingle sizes that the items use

    def __post_init__(self):
        hashes, owner = [], []
        for bound in sorted({1 << int(len(s) - 1).bit_length() for s in self.sets}):  # size classes (bound/2, bound]
            for i, s in enumerate(self.sets):
                if bound // 2 < len(s) <= bound:
                    samples = min(len(s), bound - -(-self.percent * bound // 100) + 1)
                    hashes.append(s[np.argsort(mix64(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)))[:samples]])
                    owner.append(np.full(samples, i))
        every = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.hashes = every[order]
        self.owner = np.concatenate(owner)[order] if owner else np.empty(0, np.int64)

    def search(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """(item id, its shingles, those in the document) for each item contained enough."""
        if not len(self.hashes) or not len(words):
            return []
        doc = np.concatenate([shingle_hashes(words, n) for n in self.sizes if len(words) >= n] or [np.empty(0, np.uint64)])
        at = np.searchsorted(self.hashes, doc)
        at[at == len(self.hashes)] = 0
        hit = np.unique(doc[self.hashes[at] == doc])
        if not len(hit):
            return []
        doc = np.unique(doc)
        lo, hi = np.searchsorted(self.hashes, hit), np.searchsorted(self.hashes, hit, "right")
        out = []
        for i in np.unique(np.concatenate([self.owner[a:b] for a, b in zip(lo, hi)])):
            item = self.sets[i]
            shared = len(np.intersect1d(item, doc, assume_unique=True))
            if 100 * shared >= self.percent * len(item):
                out.append((self.ids[i], len(item), shared))
        return out


def _words(text: str, known: WordHashes) -> np.ndarray:
    return known.of(text.encode("utf-8", "surrogatepass").lower().split())


def item_blocks(items: DataFrame, *, shingle: int, percent: int, block_bytes: int) -> Iterator[ItemIndex]:
    """Indexes of all items, each over at most about ``block_bytes`` of item text."""
    known = WordHashes()
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .where("text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(total // block_bytes) + 1
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        ids, sets, sizes = [], [], set()
        for r in block.collect():  # the block's share of the item table, bounded by block_bytes
            words = _words(r["text"], known)
            if len(words):
                n = min(shingle, len(words))
                ids.append(r["item_id"])
                sets.append(np.unique(shingle_hashes(words, n)))
                sizes.add(n)
        yield ItemIndex(ids, sets, percent, sorted(sizes))


def contained_items(docs: DataFrame, items: DataFrame, *, shingle: int = 5, percent: int = 80,
                    block_bytes: int = 1 << 24) -> DataFrame:
    """``(doc_id, item_id, n_item_shingles, n_shared, containment)`` for every document and item of
    ``docs(doc_id, text)`` and ``items(item_id, text)`` with ``100 * n_shared >= percent * n_item_shingles``.

    Words are apart by ASCII white space, A-Z lower-cased; sets are those of
    distinct runs of ``shingle`` words. An item with fewer words is the one run
    that it is. Null and empty texts contain nothing and are in nothing. Repeated
    rows of ``docs`` each bring their pairs, repeated rows of ``items`` count once.
    Other columns are ignored; an empty table gives no rows. Items are searched
    in blocks of ``block_bytes`` of their text, one pass over ``docs`` each.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .where("text is not null")
    out = None
    for index in item_blocks(items, shingle=shingle, percent=percent, block_bytes=block_bytes):
        part = _searched(source, index).select("doc_id", F.explode("found").alias("f")).select(
            "doc_id", "f.item_id", F.col("f.n_item").alias("n_item_shingles"), "f.n_shared",
            (F.col("f.n_shared") / F.col("f.n_item")).alias("containment"))
        out = part if out is None else out.unionByName(part)
    return out


def _searched(source: DataFrame, index: ItemIndex) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            found = [index.search(_words(t, known)) for t in texts_of(batch.column(1))]
            full = np.flatnonzero([bool(f) for f in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(full)),
                 pa.array([[dict(zip(_FOUND.names, x)) for x in found[i]] for i in full], pa.list_(_FOUND))],
                names=["doc_id", "found"])

    return source.mapInArrow(tidy(run), "doc_id long, found array<struct<item_id:long,n_item:long,n_shared:long>>")


def without_items(docs: DataFrame, items: DataFrame, *, shingle: int = 5, percent: int = 80,
                  block_bytes: int = 1 << 24) -> DataFrame:
    """The rows of ``docs`` that contain no item; all columns pass through, null texts stay."""
    place = docs.columns.index("text")
    kept = docs
    for index in item_blocks(items, shingle=shingle, percent=percent, block_bytes=block_bytes):
        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            known = WordHashes()
            for batch in batches:
                clean = [not index.search(_words(t, known)) for t in texts_of(batch.column(place))]
                yield batch.filter(pa.array(clean, pa.bool_()))

        kept = kept.mapInArrow(tidy(run), T.StructType(docs.schema.fields))
    return kept
