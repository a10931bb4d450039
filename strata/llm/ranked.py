"""Ranked lexical search with range-maximum tables over posting lists.

A task lists the postings of its documents for the terms that are asked for,
with an impact for each, and lays a sparse table over every list: the place of
the largest impact in each run of 2, 4, 8, ... postings. Two look-ups then give
the maximum over any interval of documents, and their sum over an item's terms
bounds every score in the interval. Intervals are taken best first. One is split
at the document of its largest impact, whose score is summed, and what is left
on either side gets a bound of its own; intervals that can't reach the item's
k-th best score are dropped.

All items' intervals are handled together in numpy, the best quarter of every
item's in a round. Similar documents are put side by side first, so that bounds
are tight. Items come in blocks of bounded size, and a task returns at most
``k`` rows an item.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, texts_of, tidy

_PART_WORDS = 2_000_000  # words of the documents whose postings a task holds at a time
_PART_DOCS = 16_384
_LEAST_SPLITS = 16  # intervals of an item that are split in a round at least
_NO_ID = np.iinfo(np.int64).max  # a null id, behind all others
#: Letters and digits of ASCII and all other bytes above it stay, A-Z in lower case.
_KEPT = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, with repeats."""
    return (text or "").encode().translate(_KEPT).split()


@dataclass
class Asked:
    """A block of items: ``item[i]`` asks for term ``term[i]`` (its number in ``numbers``) of weight ``weight[i]``."""

    numbers: dict[bytes, int]
    rows: np.ndarray
    item: np.ndarray
    term: np.ndarray
    weight: np.ndarray | None = None


@dataclass
class Postings:
    """Lists of all terms, one behind the other: ``place`` of the document, ``impact``, and where
    term t's list starts. ``key`` is term * n_docs + place; ``ids`` are the documents' ids by place."""

    ids: np.ndarray
    place: np.ndarray
    impact: np.ndarray
    start: np.ndarray
    key: np.ndarray


def _postings(docs: list[tuple[int, list[bytes]]], asked: Asked, n_docs: int, n_terms: int) -> Postings:
    lengths = np.array([len(w) for _, w in docs], np.int64)
    ids = np.array([d for d, _ in docs], np.int64)
    size, n_asked = len(docs), len(asked.numbers)
    number = asked.numbers.get
    word = np.concatenate([np.fromiter((number(x, -1) for x in w), np.int64, len(w)) for _, w in docs])
    mine = np.flatnonzero(word >= 0)
    key, tf = np.unique(word[mine] * size + np.repeat(np.arange(size), lengths)[mine], return_counts=True)
    term, doc, tf = key // size, key % size, tf.astype(np.int64)
    # documents with the same leading term (the most widespread of theirs) and like lengths go side by side
    spread = np.bincount(term, minlength=n_asked)
    rank = np.empty(n_asked, np.int64)
    rank[np.argsort(-spread, kind="stable")] = np.arange(n_asked)
    lead = np.full(size, n_asked)
    np.minimum.at(lead, doc, rank[term])
    order = np.lexsort((ids, lengths, lead))
    place = np.empty(size, np.int64)
    place[order] = np.arange(size)
    norm = 10 + 90 * lengths[doc] * n_docs // n_terms
    impact = 1_000_000_000 * tf // (1000 * tf + 8 * norm)
    key = term * size + place[doc]
    by = np.argsort(key, kind="stable")
    start = np.searchsorted(term[by], np.arange(n_asked + 1))
    return Postings(ids[order], place[doc][by], impact[by], start, key[by])


class Maxima:
    """Sparse table: the place of the largest value in any range of an array, the first of equal ones."""

    def __init__(self, values: np.ndarray, longest: int):
        self.values = values
        self.levels = [np.arange(len(values), dtype=np.int32)]
        step = 1
        while 2 * step <= longest:
            below = self.levels[-1]
            left, right = below[:-step], below[step:]
            level = below.copy()
            level[:-step] = np.where(values[left] >= values[right], left, right)
            self.levels.append(level)
            step *= 2
        # one row a level
        self.table = np.concatenate(self.levels) if len(values) else np.empty(0, np.int32)

    def __call__(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """For ranges [first, end), none of them empty or longer than ``longest``."""
        level = np.frexp((end - first).astype(np.float64))[1] - 1
        base = level * len(self.values)
        left, right = self.table[base + first], self.table[base + end - (1 << level)]
        return np.where(self.values[left] >= self.values[right], left, right)


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes start, start + 1, ... of each span, one span behind the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


@dataclass
class Best:
    """The ``k`` best documents of each item so far."""

    k: int
    item: np.ndarray
    score: np.ndarray
    doc: np.ndarray

    def add(self, item, score, doc):
        item, score, doc = (np.concatenate(x) for x in ((self.item, item), (self.score, score), (self.doc, doc)))
        order = np.lexsort((doc, -score, item))
        first = np.searchsorted(item[order], item[order])
        order = order[np.arange(len(order)) - first < self.k]
        self.item, self.score, self.doc = item[order], score[order], doc[order]

    def floors(self, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What a document has to reach: the k-th best score, and with that score, a smaller id."""
        score, doc = floor.copy(), np.full(len(floor), _NO_ID)
        last = np.flatnonzero(np.arange(len(self.item)) - np.searchsorted(self.item, self.item) == self.k - 1)
        at, found = self.item[last], self.score[last]
        doc[at] = np.where(found >= score[at], self.doc[last], doc[at])
        score[at] = np.maximum(found, score[at])
        return score, doc


@dataclass
class Intervals:
    """Intervals of documents: ``item``, ``bound``, the documents ``lo`` to ``hi``; ``count`` terms of the item occur
    in each. Of these, by interval: weight, the list's part [``first``, ``end``) inside, the place of its largest impact."""

    item: np.ndarray
    bound: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    count: np.ndarray
    terms: tuple[np.ndarray, ...]

    @classmethod
    def of(cls, item, lo, hi, count, base, weight, first, end, impact, maxima):
        """Without the intervals in which no term occurs."""
        there = count > 0
        item, lo, hi, count = item[there], lo[there], hi[there], count[there]
        top = maxima(first, end)
        bound = np.add.reduceat(weight * impact[top], np.cumsum(count) - count) if len(count) else np.empty(0, np.int64)
        return cls(item, bound, lo, hi, count, (base, weight, first, end, top))

    def take(self, which: np.ndarray) -> Intervals:
        spans = _spans((np.cumsum(self.count) - self.count)[which], self.count[which])
        return Intervals(self.item[which], self.bound[which], self.lo[which], self.hi[which], self.count[which],
                         tuple(x[spans] for x in self.terms))

    def join(self, other: Intervals) -> Intervals:
        def both(a, b):
            return np.concatenate([a, b])
        return Intervals(both(self.item, other.item), both(self.bound, other.bound), both(self.lo, other.lo),
                         both(self.hi, other.hi), both(self.count, other.count), tuple(map(both, self.terms, other.terms)))


def _search(part: Postings, asked: Asked, best: Best, floor: np.ndarray) -> None:
    """Bring the best documents of a part into ``best``."""
    size = len(part.ids)
    length = np.diff(part.start)
    maxima = Maxima(part.impact, int(length.max(initial=0)))
    least = Maxima(-part.ids, size)
    here = np.flatnonzero(length[asked.term] > 0)
    item, term, weight = asked.item[here], asked.term[here], asked.weight[here]
    items, count = np.unique(item, return_counts=True)
    open_ = Intervals.of(items, np.zeros(len(items), np.int64), np.full(len(items), size - 1), count, term * size, weight,
                         part.start[term], part.start[term + 1], part.impact, maxima)
    while True:
        score, doc = best.floors(floor)
        first_id = part.ids[least(open_.lo, open_.hi + 1)]
        hope = (open_.bound > score[open_.item]) | ((open_.bound == score[open_.item]) & (first_id < doc[open_.item]))
        open_ = open_.take(np.flatnonzero(hope))
        if not len(open_.item):
            return
        order = np.lexsort((-open_.bound, open_.item))
        by_item = open_.item[order]
        place = np.arange(len(order)) - np.searchsorted(by_item, by_item)
        many = np.bincount(by_item)[by_item]
        now = place < np.maximum(many // 4, _LEAST_SPLITS)
        chosen, open_ = open_.take(order[now]), open_.take(order[~now])
        # the document of the largest impact of each interval
        base, weight, first, end, top = chosen.terms
        owner = np.repeat(np.arange(len(chosen.item)), chosen.count)
        starts = np.cumsum(chosen.count) - chosen.count
        value = weight * part.impact[top]
        largest = np.flatnonzero(value == np.maximum.reduceat(value, starts)[owner])
        split = part.place[top[largest[np.unique(owner[largest], return_index=True)[1]]]]
        at = np.searchsorted(part.key, base + split[owner])
        held = (at < end) & (part.key[np.minimum(at, len(part.key) - 1)] == base + split[owner])
        total = np.add.reduceat(np.where(held, weight * part.impact[np.minimum(at, len(part.key) - 1)], 0), starts)
        best.add(chosen.item, total, part.ids[split])
        for lo, hi, a, b in ((chosen.lo, split - 1, first, at), (split + 1, chosen.hi, at + held, end)):
            inside = a < b
            open_ = open_.join(Intervals.of(chosen.item, lo, hi, np.bincount(owner[inside], minlength=len(split)), base[inside],
                                            weight[inside], a[inside], b[inside], part.impact, maxima))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """Id and terms of each document that has any."""
    for batch in batches:
        ids = batch.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False).tolist()
        for doc, text in zip(ids, texts_of(batch.column(1))):
            words = terms(text)
            if words:
                yield doc, words


def _statistics(docs: DataFrame, asked: Asked) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and for each term that is asked for, the documents that have it."""
    size = len(asked.numbers)
    numbers = asked.numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(size + 2, np.int64)
        count: Counter = Counter()
        for _, words in _documents(batches):
            count.update(set(words) & numbers.keys())
            found[-2] += 1
            found[-1] += len(words)
        for t, n in count.items():
            found[numbers[t]] = n
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[some])], ["number", "n"])

    out = np.zeros(size + 2, np.int64)
    for row in docs.mapInArrow(tidy(run), "number long, n long").groupBy("number").agg(F.sum("n").alias("n")).collect():
        out[row.number] = row.n
    return int(out[-2]), int(out[-1]), out[:-2]


def _asked(rows: list) -> Asked:
    numbers: dict[bytes, int] = {}
    item, term = [], []
    for at, row in enumerate(rows):
        for t in sorted(set(terms(row.text))):
            item.append(at)
            term.append(numbers.setdefault(t, len(numbers)))
    return Asked(numbers, np.array([r.row for r in rows], np.int64), np.array(item, np.int64), np.array(term, np.int64))


def _search_block(docs: DataFrame, asked: Asked, k: int) -> DataFrame:
    """``(row, doc_id, score)``: the ``k`` best documents of each task for each item of a block."""
    n_docs, n_terms, df = _statistics(docs, asked)
    weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)[asked.term]
    worth = (df[asked.term] > 0) & (weight > 0)
    asked = Asked(asked.numbers, asked.rows, asked.item[worth], asked.term[worth], weight[worth])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        best = Best(k, none, none, none)
        floor = np.ones(len(asked.rows), np.int64)  # a score of 1 at least
        part, words = [], 0

        def search():
            _search(_postings(part, asked, n_docs, n_terms), asked, best, floor)

        for doc in _documents(batches):
            part.append(doc)
            words += len(doc[1])
            if words >= _PART_WORDS or len(part) >= _PART_DOCS:
                search()
                part, words = [], 0
        if part:
            search()
        yield pa.RecordBatch.from_arrays([pa.array(asked.rows[best.item]), pa.array(best.doc, mask=best.doc == _NO_ID),
                                          pa.array(best.score)], ["row", "doc_id", "score"])

    return docs.mapInArrow(tidy(run), "row long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_bytes: int = 4 << 20) -> DataFrame:
    """The ``k`` documents of the highest score above 0 for each item: ``(item_id, rank, doc_id, score)``.

    ``docs(doc_id, text)`` and ``items(item_id, text)`` may have other columns; null and empty texts have no
    terms, so such documents are found by nothing and such items find nothing. Equal scores are ranked by ascending
    id, null ids last; rows that repeat are documents, and items, of their own. A weight of a term and a document's
    score are whole numbers (README). Items are read in blocks of about ``block_bytes`` of text, each one pass for
    the statistics and one for the search, so neither the driver nor a task holds more of them.
    """
    docs = docs.select("doc_id", "text")
    rows = staged(items.select("item_id", "text").withColumn("row", F.monotonically_increasing_id()), "ranked-items")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = -(-size // block_bytes)
    found = []
    for block in range(n_blocks):
        asked = _asked(rows.where(F.pmod(F.xxhash64("row"), F.lit(n_blocks)) == block).orderBy("row").collect())
        if asked.numbers:
            found.append(staged(_search_block(docs, asked, k), "ranked-found"))
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    every = reduce(DataFrame.unionByName, found)
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(rows.select("row", "item_id"), "row").select("item_id", "rank", "doc_id", "score")
