"""Document fingerprints by consistent weighted sampling.

A text's weighted terms are its word shingles with their counts. For each of
``SAMPLES`` samples a term of weight S has, from its hash alone, r and c drawn
from Gamma(2, 1) and b drawn uniformly; with t = floor(ln S / r + b) and
y = exp(r (t - b)) the term with the smallest c / (y exp(r)) is taken, and
(term, t) is the sample. Two texts agree in a sample with probability equal to
the generalised Jaccard similarity, sum of minima over sum of maxima, of their
counts.

The draws come from a table of 65,536 triples at equally spaced quantiles in
random combination; 16 hash bits of the term choose the triple. Terms of one
text that choose the same triple tie, and the smaller hash wins in every text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import even_parts, mix64, shingle_hashes, tidy, WordHashes

SAMPLES = 64


@cache
def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """r, ln c, b of the table; sortable ln a of weight 1; multipliers of the samples."""
    rng = np.random.default_rng(20240611)
    n = 1 << 16
    # Gamma(2, 1) quantiles by solving 1 - (1 + x) exp(-x) = u with Newton steps
    u = (np.arange(n) + 0.5) / n
    x = np.sqrt(2 * u) + u
    for _ in range(60):
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - u) / (x * np.exp(-x)), x / 2)
    r, c, b = rng.permutation(x), np.log(rng.permutation(x)), rng.permutation(u)
    multipliers = rng.integers(0, 2**63, SAMPLES, np.uint64) * np.uint64(2) + np.uint64(1)
    return r, c, b, _sortable(c + r * b - r), multipliers


def _sortable(x: np.ndarray) -> np.ndarray:
    """Unsigned integers in the order of the floats, in the upper 32 bits."""
    u = x.astype(np.float32).view(np.uint32)
    u = np.where(u >> 31, ~u, u | np.uint32(0x80000000))
    return u.astype(np.uint64) << np.uint64(32)


def samples(terms: list[np.ndarray], weights: list[np.ndarray]) -> np.ndarray:
    """(len(terms), SAMPLES) 16-bit samples; terms sorted and distinct in each set, no set empty."""
    r, c, b, plain, multipliers = _draws()
    every, weight = np.concatenate(terms), np.concatenate(weights)
    sizes = np.fromiter(map(len, terms), np.int64, len(terms))
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(every), dtype=np.uint64)
    more = np.flatnonzero(weight > 1)
    log = np.log(weight[more].astype(float))
    out = np.empty((len(terms), SAMPLES), np.uint16)
    for k in range(SAMPLES):
        draw = (every * multipliers[k]) >> np.uint64(48)
        key = plain[draw] | place
        if len(more):
            d = draw[more]
            t = np.floor(log / r[d] + b[d])
            key[more] = _sortable(c[d] - r[d] * (t - b[d]) - r[d]) | place[more]
        best = (np.minimum.reduceat(key, starts) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        d = draw[best]
        t = np.floor(np.log(weight[best].astype(float)) / r[d] + b[d])
        sample = mix64(every[best] + t.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        out[:, k] = (sample >> np.uint64(16)).astype(np.uint16)
    return out


class Fingerprinter:
    def __init__(self, shingle: int):
        self.shingle, self.known = shingle, WordHashes()

    def __call__(self, texts: list[str]) -> list[np.ndarray | None]:
        """The samples of each text; None for a text without a word."""
        out: list[np.ndarray | None] = [None] * len(texts)
        terms, weights, which, size = [], [], [], 0

        def flush():
            for i, s in zip(which, samples(terms, weights)):
                out[i] = s
            terms.clear(), weights.clear(), which.clear()

        for i, text in enumerate(texts):
            words = self.known.of(text.encode("utf-8", "surrogatepass").lower().split())
            if len(words):
                t, w = np.unique(shingle_hashes(words, self.shingle), return_counts=True)
                terms.append(t), weights.append(w), which.append(i)
                size += len(t)
                if size > 30_000:
                    size = 0
                    flush()
        if terms:
            flush()
        return out


def as_text(samples_: np.ndarray | None) -> str:
    """Four hexadecimal digits a sample; a text without a word has an empty fingerprint."""
    return "" if samples_ is None else samples_.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """Share of equal samples; 1 if both are empty, 0 if one is."""
    if a is None or b is None:
        return float(a is b)
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def fingerprint_neighbours(docs: DataFrame, *, shingle: int = 5) -> DataFrame:
    """Fingerprints of ``docs(doc_id, text)`` and of each text edited with the next one's beginning.

    ``near_edited`` and ``near_next`` compare a document's fingerprint with that
    of its edited text and of the next document in ascending ``doc_id`` (the
    first comes after the last). A null text is empty. Null ids come before all
    others; rows with equal ids follow one another in a fixed order. Other
    columns are ignored; an empty table gives no rows.

    Texts are shuffled once, compressed, to ranges of ids; the first document of
    a range goes to the range before it as well, so each task has every next one.
    """
    parts = even_parts(docs)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = source.select("doc_id")
    # one id for each range: the first of every partition
    firsts = ids.repartitionByRange(parts, "doc_id").groupBy(F.spark_partition_id().alias("p")).agg(
        F.min("doc_id").alias("first"), F.max(F.col("doc_id").isNull()).alias("nulls")).collect()
    bounds = np.array(sorted({r["first"] for r in firsts if r["first"] is not None}), np.int64)
    nulls = any(r["nulls"] for r in firsts)
    last = max(len(bounds) - 1, 0)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(3)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0), batch.column(1)):
                doc = doc.as_py()
                blob = press.compress(text.as_buffer()) if text.is_valid and text.as_buffer().size else None
                bucket = 0 if doc is None else int(np.searchsorted(bounds, doc, "right")) - 1
                rows.append((bucket, 0, doc, blob))
                if (doc is None) if nulls else (doc == bounds[0]):
                    rows.append((last, 1, doc, blob))
                if doc is not None and bucket > 0 and doc == bounds[bucket]:
                    rows.append((bucket - 1, 1, doc, blob))
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.binary())], names=["bucket", "tail", "doc_id", "blob"])

    # the last range's next document is the first of all: it comes after any other tail, of which that range has none
    dealt = source.mapInArrow(tidy(deal), "bucket int, tail int, doc_id long, blob binary") \
        .repartition(parts, "bucket").sortWithinPartitions("bucket", "tail", F.asc_nulls_first("doc_id"), F.asc_nulls_first("blob"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Fingerprinter(shingle)

        def rows():
            before = None
            for batch in batches:
                for bucket, tail, doc, blob in zip(*batch.columns):
                    text = zstandard.decompress(blob.as_py()).decode("utf-8", "surrogatepass") if blob.is_valid else ""
                    row = (bucket.as_py(), tail.as_py(), doc.as_py(), text)
                    if before is not None and before[0] == row[0] and not before[1]:
                        yield before[2], before[3], text
                    before = row

        def flush(held):
            texts = [t for _, t, _ in held] + [n for _, _, n in held[-1:]]
            # the next text of a row is the text of the row after it, except where a range ends
            apart = [i for i in range(len(held) - 1) if held[i][2] is not texts[i + 1]]
            changed = [edited(t, n) for _, t, n in held]
            got = prints(texts + [held[i][2] for i in apart] + changed)
            own, after, new = got[:len(held)], got[1:len(held) + 1], got[len(texts) + len(apart):]
            for k, i in enumerate(apart):
                after[i] = got[len(texts) + k]
            cols = list(zip(*((d, len(t), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), as_text(a),
                               as_text(b), likeness(a, b), likeness(a, c))
                              for (d, t, _), e, a, b, c in zip(held, changed, own, new, after))))
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                              names=[x.split()[0] for x in _OUT.split(", ")])

        held, size = [], 0
        for row in rows():
            held.append(row)
            size += len(row[1])
            if size > 1 << 21:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    return dealt.mapInArrow(tidy(compare), _OUT)
