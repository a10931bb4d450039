"""Toxicity scores from a counterfactually regularised logistic model.

Features of a text are its distinct words (runs of letters and digits, lower
case) and their beginnings of 4 and 5 characters, for inflected forms. The
features that tell the labels apart most (by the G statistic) enter a logistic
model. For every labelled sentence that names a group, the group term is
swapped for another term of its list and for the list's neutral word; the
model pays for the square of each change in score, so the groups' names
themselves carry no weight of their own.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import even_parts, staged, tidy

#: Identity terms by list, the neutral word first.
IDENTITY = {
    "gender": ["person", "woman", "man", "female", "male", "girl", "boy", "transgender", "nonbinary"],
    "gender_plural": ["people", "women", "men", "females", "males", "girls", "boys"],
    "faith": ["believer", "christian", "muslim", "jew", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"],
    "faith_plural": ["believers", "christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"],
    "origin": ["citizen", "black", "white", "asian", "african", "european", "american", "latino", "arab", "immigrant"],
    "origin_plural": ["citizens", "blacks", "whites", "asians", "africans", "europeans", "americans", "latinos", "arabs",
                      "immigrants"],
    "orientation": ["adult", "gay", "lesbian", "bisexual", "straight", "queer"],
    "ability": ["resident", "blind", "deaf", "disabled", "autistic"],
}
_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(words: set[str]) -> set[str]:
    """Words and their beginnings (marked with a star; a word as long as a beginning has it too)."""
    return words | {w[:4] + "*" for w in words if len(w) >= 4} | {w[:5] + "*" for w in words if len(w) >= 5}


@dataclass
class ToxicityModel:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0

    def score(self, text: str) -> float:
        z = self.bias + sum(map(self.weights.__getitem__, self.weights.keys() & features_of(words_of(text))))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def fit_logistic(rows: list[np.ndarray], labels: np.ndarray, swaps: list[tuple[list[int], list[int]]], size: int, *,
                 ridge: float = 1e-4, swap_weight: float = 1.0, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on mean log loss + ridge + ``swap_weight`` times the mean squared
    change of the logit over ``swaps`` (features lost, features gained)."""
    every = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    gone = np.array([f for a, _ in swaps for f in a], np.int64)
    gone_of = np.array([i for i, (a, _) in enumerate(swaps) for _ in a], np.int64)
    come = np.array([f for _, b in swaps for f in b], np.int64)
    come_of = np.array([i for i, (_, b) in enumerate(swaps) for _ in b], np.int64)
    w, bias = np.zeros(size), math.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        z = bias + np.bincount(of, weights=w[every], minlength=len(rows))
        error = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels) / max(len(labels), 1)
        grad = np.bincount(every, weights=error[of], minlength=size) + ridge * w
        if swaps:
            change = (np.bincount(come_of, weights=w[come], minlength=len(swaps))
                      - np.bincount(gone_of, weights=w[gone], minlength=len(swaps))) * (2 * swap_weight / len(swaps))
            grad += np.bincount(come, weights=change[come_of], minlength=size)
            grad -= np.bincount(gone, weights=change[gone_of], minlength=size)
        g = np.append(grad, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        rate = 0.1 / max(1, step / 400)  # a constant one circles around the least loss in longer fits
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w, bias


def learn(labelled: DataFrame, *, max_rows: int = 20_000, max_features: int = 8_192, swap_weight: float = 1.0) -> ToxicityModel:
    """Fit on at most ``max_rows`` rows of ``labelled(doc_id, text, toxic)``, taken by a hash of the id.

    Rows with a null label are left out, a null text is empty, a row repeated
    counts as often as it occurs. With no row, or labels of one kind only, the
    model is the (smoothed) share of label 1 for every text. Features are
    counted on the executors; the driver gets ``max_features`` of them and, for
    the sampled rows, which of them each row has.
    """
    sample = staged(labelled.where("toxic is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        (F.col("toxic") > 0).cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
        .limit(max_rows).repartition(even_parts(labelled), F.xxhash64("doc_id", "text")), "toxicity-sample")
    kinds = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(kinds) < 2:
        n, k = sum(kinds.values()), kinds.get(1, 0)
        return ToxicityModel({}, math.log((k + 1) / (n - k + 1)))
    terms = {t for group in IDENTITY.values() for t in group}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [Counter(), Counter()]
            for text, toxic in zip(batch.column(1), batch.column(2)):
                n[toxic.as_py()].update(features_of(words_of(text.as_py())))
            names = list(n[0].keys() | n[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([n[0][x] for x in names], pa.int64()),
                                              pa.array([n[1][x] for x in names], pa.int64())], names=["feature", "n0", "n1"])

    def part(seen, base):
        """One term of G: observed times the log of observed over expected."""
        return F.when(F.col(seen) > 0, F.col(seen) * F.log(F.col(seen) / ((F.col("n0") + F.col("n1")) * base))).otherwise(0.0)

    total = kinds[0] + kinds[1]
    counts = sample.mapInArrow(tidy(count), "feature string, n0 long, n1 long").groupBy("feature").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    best = counts.where("n0 + n1 >= 5").withColumn("g", part("n0", kinds[0] / total) + part("n1", kinds[1] / total)) \
        .orderBy(F.desc("g"), "feature").limit(max_features)
    names = sorted({r["feature"] for r in best.select("feature").collect()} | terms)
    number = {n: i for i, n in enumerate(names)}

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, swaps = [], []
            for text in batch.column(1):
                text = text.as_py()
                rows.append(sorted(number[f] for f in number.keys() & features_of(words_of(text))))
                swaps.append([s for s in _swaps(text, number)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(rows, pa.list_(pa.int64())),
                 pa.array([[{"gone": a, "come": b} for a, b in x] for x in swaps],
                          pa.list_(pa.struct([("gone", pa.list_(pa.int64())), ("come", pa.list_(pa.int64()))])))],
                names=["doc_id", "toxic", "features", "swaps"])

    got = sample.mapInArrow(tidy(gather), "doc_id long, toxic int, features array<long>, swaps array<struct<gone:array<long>,come:array<long>>>") \
        .toArrow().sort_by("doc_id")  # the order of the tasks' rows doesn't matter
    rows = [np.array(r, np.int64) for r in got.column("features").to_pylist()]
    swaps = [(s["gone"], s["come"]) for x in got.column("swaps").to_pylist() for s in x]
    labels = got.column("toxic").to_numpy().astype(float)
    w, bias = fit_logistic(rows, labels, swaps, len(names), swap_weight=swap_weight)
    return ToxicityModel({n: float(x) for n, x in zip(names, w) if x}, float(bias))


def _swaps(text: str, number: dict[str, int]) -> Iterator[tuple[list[int], list[int]]]:
    """For each sentence and identity term in it: the features lost and gained by a swap for
    the neutral word and for another term (the next of its list)."""
    for sentence in _SENTENCE.split(text):
        words = words_of(sentence)
        for group in IDENTITY.values():
            for term in words.intersection(group):
                at = group.index(term)
                for other in {group[0], group[(at + 1) % len(group)]} - words:
                    before, after = features_of(words), features_of(words - {term} | {other})
                    yield (sorted(number[f] for f in number.keys() & (before - after)),
                           sorted(number[f] for f in number.keys() & (after - before)))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) to ``docs``; columns of these
    names are replaced. A null text is scored as an empty one. Rows, repeats and
    all other columns pass through."""
    keep = docs.drop("score", "predicted")
    place = keep.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t.as_py() or "") for t in batch.column(place)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                names=[*batch.schema.names, "score", "predicted"])

    return keep.mapInArrow(tidy(run), T.StructType([*keep.schema.fields, T.StructField("score", T.DoubleType()),
                                              T.StructField("predicted", T.IntegerType())]))
