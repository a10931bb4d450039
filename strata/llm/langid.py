"""Language identification by rank-order profiles.

A language's profile is the list of its most frequent character n-grams (1 to
3 letters, words marked off by a boundary) in order of frequency. A document's
most frequent n-grams are ranked the same way, and every profile gets the sum
of the differences in rank, an n-gram missing from the profile counting as the
profile's length. The nearest profile wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import tidy

UNDETERMINED = "und"
_BITS = 21  # a code point and the boundary mark fit
_EDGE = 1


class _Letters:
    """Whether a code point is a letter, for whole arrays."""

    def __init__(self):
        self.known = np.zeros(0x110000, np.int8)  # 0: not yet asked

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        got = self.known[codes]
        if (got == 0).any():
            for c in np.unique(codes[got == 0]):
                self.known[c] = 2 if chr(c).isalpha() else 1
            got = self.known[codes]
        return got == 2


def ngrams(text: str, letters: _Letters) -> np.ndarray:
    """Packed n-grams of a text, repeats included; empty if it has no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    is_letter = letters(codes)
    if not is_letter.any():
        return np.empty(0, np.int64)
    c = np.empty(len(codes) + 2, np.int64)
    c[0] = c[-1] = _EDGE
    c[1:-1] = np.where(is_letter, codes + 2, _EDGE)
    stay = np.ones(len(c), bool)
    stay[1:] = (c[1:] != _EDGE) | (c[:-1] != _EDGE)  # one boundary between words
    c = c[stay]
    two = (c[:-1] << _BITS) | c[1:]
    three = (two[:-1] << _BITS) | c[2:]
    return np.concatenate([c[c != _EDGE], two, three[c[1:-1] != _EDGE]])


def _top(grams: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent, most frequent first; equal counts in n-gram order."""
    keys, counts = np.unique(grams, return_counts=True)
    return keys[np.argsort(-counts, kind="stable")[:size]]


@dataclass(frozen=True)
class Profiles:
    """For each n-gram of any profile its rank in each language."""

    langs: list[str]
    grams: np.ndarray  # sorted
    ranks: np.ndarray  # (len(grams), len(langs)); the profile length where missing
    length: int

    def distances(self, doc: np.ndarray) -> np.ndarray:
        """Out-of-place distance to each language as a share of the largest possible."""
        at = np.searchsorted(self.grams, doc)
        at[at == len(self.grams)] = 0
        found = self.grams[at] == doc
        place = np.arange(len(doc))
        out = np.minimum(np.abs(self.ranks[at] - place[:, None]), self.length)
        out[~found] = self.length
        out[self.ranks[at] == self.length] = self.length
        return out.sum(axis=0) / (len(doc) * self.length)


def learn_profiles(rows: DataFrame, *, length: int = 400) -> Profiles:
    """Profiles of all ``rows(text, lang)``; rows with a null in either are left out.

    All n-grams of all rows are counted on the executors; what reaches the
    driver are ``length`` n-grams for each language.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _Letters()
        for batch in batches:
            by_lang: dict[str, list[np.ndarray]] = {}
            size = 0

            def flush():
                for lang, parts in by_lang.items():
                    keys, counts = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang]).take(pa.array(np.zeros(len(keys), np.int32))), pa.array(keys),
                         pa.array(counts.astype(np.int64))], names=["lang", "gram", "n"])
                by_lang.clear()

            for text, lang in zip(batch.column(0), batch.column(1)):
                g = ngrams(text.as_py(), letters)
                if len(g):
                    by_lang.setdefault(lang.as_py(), []).append(g)
                    size += len(g)
                if size > 4_000_000:
                    size = 0
                    yield from flush()
            yield from flush()

    counts = (rows.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
              .where("text is not null and lang is not null")
              .mapInArrow(tidy(count), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = (counts.withColumn("place", F.row_number().over(best)).where(F.col("place") <= length)
           .select("lang", "gram", "place").collect())
    langs = sorted({r["lang"] for r in top})
    grams = np.array(sorted({r["gram"] for r in top}), np.int64)
    ranks = np.full((len(grams), len(langs)), length, np.int64)
    for r in top:
        ranks[np.searchsorted(grams, r["gram"]), langs.index(r["lang"])] = r["place"] - 1
    return Profiles(langs, grams, ranks, length)


def predict(docs: DataFrame, profiles: Profiles, *, top: int = 300) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to ``docs`` (columns of these names are replaced).

    ``score`` is one minus the distance to the nearest profile, 0 to 1. A text
    that is null or has no letter gets ``und`` and 0; so does every text if no
    language was learned. Equal distances go to the language first in
    alphabetical order. All other columns, rows and repeats pass through.
    """
    from pyspark.sql import types as T

    keep = docs.drop("lang_pred", "score")
    schema = T.StructType([*keep.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    place = keep.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _Letters()
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(place):
                g = ngrams(text.as_py() or "", letters) if profiles.langs else ()
                if len(g):
                    d = profiles.distances(_top(g, top))
                    k = int(np.argmin(d))
                    langs.append(profiles.langs[k])
                    scores.append(1.0 - float(d[k]))
                else:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])

    return keep.mapInArrow(tidy(run), schema)


def least_score(judged: DataFrame, *, quantile: float = 0.01, share: float = 0.6) -> float:
    """A score that prose in the learned languages exceeds: ``share`` of the lower ``quantile`` of the scores
    that the learning rows ``judged(lang_pred, score)`` have themselves (0 without any).

    Random letters and encoded data score a third of what prose does at most, and so does a few lines' text in
    another language of the same script; a few words of it tell too little and can pass."""
    told = judged.where(F.col("lang_pred") != UNDETERMINED)
    return share * (told.agg(F.percentile_approx("score", quantile, 10_000)).first()[0] or 0.0)


def remainder(doc_id: str, by: int) -> Column:
    """crc32 of the id's text modulo ``by``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % by
