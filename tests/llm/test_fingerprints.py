import hashlib
import random

import numpy as np
import pytest
from strata.llm.fingerprints import Fingerprinter, as_text, edited, fingerprint_neighbours, likeness, samples


def jaccard(a, b):
    keys = set(a) | set(b)
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)


@pytest.mark.parametrize("low,high", [(1, 1), (1, 6)])
def test_collisions_estimate_generalised_jaccard(low, high):
    rng = np.random.default_rng(low + high)
    terms, weights, want = [], [], []
    for _ in range(300):
        keys = np.unique(rng.integers(0, 2**63, 60, np.uint64))
        sets = []
        for _ in range(2):
            mine = keys[rng.random(len(keys)) < 0.8]
            w = rng.integers(low, high + 1, len(mine))
            terms.append(mine), weights.append(w), sets.append(dict(zip(mine.tolist(), w.tolist())))
        want.append(jaccard(*sets))
    got = samples(terms, weights)
    share = (got[0::2] == got[1::2]).mean(axis=1)
    assert abs(share.mean() - np.mean(want)) < 0.01
    assert np.abs(share - want).max() < 0.3


def brute(docs):
    f = Fingerprinter(5)
    rows = sorted(docs, key=lambda r: (r[0] is not None, r[0]))
    out = []
    for k, (d, t) in enumerate(rows):
        t, n = t or "", rows[(k + 1) % len(rows)][1] or ""
        e = edited(t, n)
        a, b, c = f([t, e, n])
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), as_text(a), as_text(b), likeness(a, b), likeness(a, c)))
    return out


def test_against_brute_force(spark):
    rnd = random.Random(3)
    words = ["ab", "çé", "x", "😀y", "z\n"]
    docs = [(i * 7, " ".join(rnd.choice(words) for _ in range(rnd.randrange(60)))) for i in range(150)]
    docs += [(-5, None), (None, "the null id"), (2000, "")]
    df = spark.createDataFrame([(d, t, "s") for d, t in docs], "doc_id long, text string, fingerprint string").repartition(4)
    got = sorted((tuple(r) for r in fingerprint_neighbours(df).collect()), key=lambda r: (r[0] is not None, r[0]))
    assert got == brute(docs)
    one = spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")
    assert [tuple(r) for r in fingerprint_neighbours(one).collect()] == brute([(1, "a b c d e f g h")])
    assert fingerprint_neighbours(one.limit(0)).collect() == []


def test_repeated_rows_stay(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (2, "c")], "doc_id long, text string")
    got = fingerprint_neighbours(df).collect()
    assert sorted(r.doc_id for r in got) == [1, 1, 2, 2]
    assert sorted(r.near_next for r in got if r.doc_id == 1) == [0.0, 1.0]
