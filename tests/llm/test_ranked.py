import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from strata.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def brute(docs, items, k):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    bags = [(d, Counter(plain_terms(t))) for d, t in docs]
    bags = [(d, c, sum(c.values())) for d, c in bags if c]
    n, total = len(bags), sum(x for *_, x in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, size in bags:
            m = 100 - 90 + (90 * size * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in set(plain_terms(text)) if t in c)
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, at + 1, d, -s) for at, (s, *_, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def tables(seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "naïve", "漢字", "x_y", "A-b"]

    def text(n):
        return " ".join(words[min(int(rnd.expovariate(0.08)), len(words) - 1)] for _ in range(n))

    docs = [(i, text(rnd.randrange(1, 60))) for i in range(300)]
    docs += [(1000 + i, "w1 w2 w3 w40") for i in range(40)]  # copies tie
    docs += [(2000, None), (2001, ""), (2002, " .,;"), (None, "w1 w2 w40"), (2003, "w5 " * 50_000), (2004, "w7"), (2004, "w7"), (2005, "naÏve É")]
    items = [(i, text(rnd.randrange(1, 25))) for i in range(25)]
    items += [(100, None), (101, "..."), (102, "unknownterm"), (103, "w1 w2 w3 w40"), (104, "W7 w7"), (None, "w5"), (105, "É naïve x y")]
    return docs, items


@pytest.mark.parametrize("seed,part,block", [(1, 16_384, 4 << 20), (2, 50, 4 << 20), (3, 7, 300)])
def test_against_scoring_everything(spark, monkeypatch, seed, part, block):
    monkeypatch.setattr(ranked, "_PART_DOCS", part)
    docs, items = tables(seed)
    d = spark.createDataFrame([(*r, 1, 2) for r in docs], "doc_id long, text string, row long, score int").repartition(3)
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    got = sorted((tuple(r) for r in ranked.search(d, i, k=10, block_bytes=block).collect()), key=repr)
    assert got == brute(docs, items, 10)


def test_maxima_are_those_of_the_ranges():
    rnd = np.random.default_rng(5)
    values = rnd.integers(0, 20, 300)
    table = ranked.Maxima(values, 300)
    first = rnd.integers(0, 299, 2000)
    end = np.array([rnd.integers(a + 1, 301) for a in first])
    got = table(first, end)
    assert all(f <= g < e and values[g] == values[f:e].max() for f, e, g in zip(first, end, got))


def test_few_documents_are_scored():
    """A document that holds an item's rare words is found without scoring most of the others."""
    docs, _ = tables(9)
    docs = [(i, ranked.terms(t)) for i, (_, t) in enumerate(docs * 5) if ranked.terms(t)] + [(10_000, [b"rare", b"w1", b"w2"])]
    row = type("Row", (), {"row": 0, "text": "rare w1"})
    asked = ranked._asked([row])
    asked.weight = np.array([9000 if t == asked.numbers[b"rare"] else 10 for t in asked.term])
    none = np.empty(0, np.int64)
    best = ranked.Best(1, none, none, none)
    scored = []
    add = best.add
    best.add = lambda item, score, doc: (scored.extend(doc), add(item, score, doc))
    ranked._search(ranked._postings(docs, asked, len(docs), sum(len(w) for _, w in docs)), asked, best, np.ones(1, np.int64))
    assert best.doc.tolist() == [10_000] and len(scored) < len(docs) / 20


def test_no_rows(spark):
    docs, items = tables(4)
    d, i = (spark.createDataFrame(r, f"{c} long, text string") for r, c in ((docs, "doc_id"), (items, "item_id")))
    assert ranked.search(d.limit(0), i).collect() == []
    assert ranked.search(d, i.limit(0)).collect() == []
