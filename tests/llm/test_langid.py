"""Rank-order profiles against plain Python, and their accuracy on held-out documents."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from strata.llm import langid
from strata.llm.common import documents
from strata.llm.queries import op3_language_id


def plain_ngrams(text):
    """Letters alone, and pairs and triples of letters and word edges; the middle of a triple is no edge."""
    text = text.lower()
    if not any(c.isalpha() for c in text):
        return []
    chars = "_" + "".join(c if c.isalpha() else "_" for c in text) + "_"
    while "__" in chars:
        chars = chars.replace("__", "_")
    out = [c for c in chars if c != "_"]
    out += [chars[i:i + 2] for i in range(len(chars) - 1)]
    return out + [chars[i:i + 3] for i in range(len(chars) - 2) if chars[i + 1] != "_"]


def key(gram):
    """The order of n-grams that tie: that of the packed code points."""
    value = 0
    for c in gram:
        value = (value << 21) | (1 if c == "_" else ord(c) + 2)
    return value


def ranked(counts, size):
    return sorted(counts, key=lambda g: (-counts[g], key(g)))[:size]


def test_scores_are_the_plain_distances(spark):
    sf = "/root/testdata/sf0.001"
    docs = documents(spark, sf)
    learning = langid.remainder("doc_id", 3) != 1
    counts = {}
    for r in docs.where(learning).collect():
        if r.text and r.lang:
            counts.setdefault(r.lang, Counter()).update(plain_ngrams(r.text))
    profiles = {lang: {g: i for i, g in enumerate(ranked(c, 400))} for lang, c in counts.items()}
    got = langid.predict(docs, langid.learn_profiles(docs.where(learning))).collect()
    assert len(got) == docs.count()
    for r in got:
        mine = ranked(Counter(plain_ngrams(r.text or "")), 300)
        if not mine:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        far = {lang: sum(min(abs(p[g] - i), 400) if g in p else 400 for i, g in enumerate(mine)) / (400 * len(mine))
               for lang, p in profiles.items()}
        best = min(sorted(far), key=far.get)
        assert r.lang_pred == best and r.score == pytest.approx(1 - far[best])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = op3_language_id(spark, sf).join(documents(spark, sf).select("doc_id", "lang"), "doc_id") \
        .where("held_out and lang is not null and lang_pred <> 'und'")
    right, n = got.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")), F.count("*")).first()
    assert n > 250 and right > 0.98
