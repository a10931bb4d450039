import random

import numpy as np
import pytest
from strata.llm import common, neardup
from strata.llm.containment import contained_items


def brute(docs, size, percent):
    """component and size of every row by comparing all pairs."""
    def sets(text):
        words = (text or "").encode().lower().split()
        if len(words) < size:
            return frozenset([tuple(words)] if words else [])
        return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))

    rows = [(d, sets(t)) for d, t in docs]
    least = {d: d for d, _ in rows if d is not None}

    def find(d):
        while least[d] != d:
            d = least[d]
        return d

    for i, (a, x) in enumerate(rows):
        for b, y in rows[:i]:
            if x and y and a is not None and b is not None and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                least[q] = p
    return sorted(((d, len(s), None if d is None else find(d), d is None or find(d) == d) for d, s in rows), key=repr)


def corpus(seed, groups, copies):
    rnd = random.Random(seed)
    docs = [(9000, None), (9001, ""), (9002, " \t\n"), (None, "a b c d e"), (9003, "One two"), (9004, "one TWO"), (9004, "one TWO"),
            (9005, "w " * 20_000)]
    for g in range(groups):
        base = [f"w{rnd.randrange(3000)}" for _ in range(rnd.randrange(30, 120))]
        for _ in range(copies):
            words = list(base)
            for _ in range(rnd.randrange(6)):
                words[rnd.randrange(len(words))] = f"x{rnd.randrange(3000)}"
            docs.append((len(docs), " ".join(words)))
    return docs


@pytest.mark.parametrize("block", [512, 16])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)  # small blocks: groups span several
    docs = corpus(block, 3, 60)
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, component_id string").repartition(3)
    got = sorted((tuple(r) for r in neardup.near_duplicates(df, shingle=4, percent=80).collect()), key=repr)
    assert got == brute(docs, 4, 80)


@pytest.mark.parametrize("hub", [64, 2])
def test_components_with_hubs(spark, monkeypatch, hub):
    monkeypatch.setattr(common, "HUB", hub)  # of 2: most inner nodes are hubs
    rnd = random.Random(hub)
    edges = [(5, n) for n in range(1000, 1200)] + [(n, n + 1) for n in range(2000, 2040)]  # a star, a path
    edges += [(rnd.randrange(3000, 3300), rnd.randrange(3000, 3300)) for _ in range(200)] + [(1100, 2020), (7, 7), (8, None)]
    least = {}
    for a, b in edges:
        if b is not None and a != b:
            least.setdefault(a, a), least.setdefault(b, b)
    moved = True
    while moved:
        moved = False
        for a, b in edges:
            if b is not None and a != b and least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                moved = True
    df = spark.createDataFrame(edges + edges[:50] + [(b, a) for a, b in edges[50:90]], "a long, b long")
    assert sorted(map(tuple, common.components(df).collect())) == sorted(least.items())
    assert common.components(df.limit(0)).collect() == []


def test_steps_of_components_have_small_plans(spark, monkeypatch):
    """The driver keeps the plans of all steps, their compiled code and broadcasts: each step has few joins, and only
    hubs may be broadcast, whatever the session allows."""
    joins = []

    def seen(df, name):
        lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        joins.append([line for line in lines if "Join " in line])
        return staged(df, name)

    staged = common.staged
    monkeypatch.setattr(common, "staged", seen)
    df = spark.createDataFrame([(n, n + 1) for n in range(40)] + [(50, n) for n in range(51, 130)], "a long, b long")
    got = sorted(map(tuple, common.components(df).collect()))
    assert got == [(n, 0) for n in range(41)] + [(n, 50) for n in range(50, 130)]
    assert max(map(len, joins)) == 3
    assert all("strategy=merge" in line or "strategy=broadcast" in line for found in joins for line in found)
    assert max(sum("strategy=broadcast" in line for line in found) for found in joins) == 2  # one exchange, read twice


def test_components_that_are_stars_take_no_step(spark, monkeypatch):
    written = []
    monkeypatch.setattr(common, "staged", lambda df, name, staged=common.staged: written.append(name) or staged(df, name))
    df = spark.createDataFrame([(n // 10 * 10, n) for n in range(100)], "a long, b long")
    assert sorted(map(tuple, common.components(df, "stars").collect())) == [(n, n // 10 * 10) for n in range(100)]
    assert written == ["stars"]


def test_no_rows(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_least_matches_bound_the_miss_probability():
    rng = np.random.default_rng(5)
    least = neardup.least_matches(0.8, 1e-3)
    match = rng.random((200_000, 128)) < rng.uniform(0.8, 1.0, (200_000, 1))  # pairs at or over the threshold
    pruned = np.zeros(len(match), bool)
    for n, m in zip(neardup.BATCHES, least):
        pruned |= match[:, :n].sum(axis=1) < m
    assert pruned.mean() < 4 * 1e-3


def test_contained_items_edges(spark):
    items = [(1, "a b c d e f g"), (2, "x y"), (3, ""), (4, None), (1, "a b c d e f g"), (5, "q r s t u v w x y z")]
    docs = [(10, "0 A b C d e f g 1"), (11, "z x y z"), (12, None), (12, ""), (13, "q r s t u v w x y"), (13, "q r s t u v w x y"),
            (14, "a b c d e f"), (15, "n " * 50_000 + "a b c d e f g")]
    d = spark.createDataFrame([(a, b, "c") for a, b in docs], "doc_id long, text string, item_id string")
    i = spark.createDataFrame(items, "item_id long, text string")
    want = [(10, 1, 3, 3), (11, 2, 1, 1), (13, 2, 1, 1), (13, 2, 1, 1), (13, 5, 6, 5), (13, 5, 6, 5), (15, 1, 3, 3)]
    for size in (1 << 24, 8):  # one block, many blocks
        got = contained_items(d, i, block_bytes=size).collect()
        assert sorted(tuple(r)[:4] for r in got) == want
    assert contained_items(d.limit(0), i).collect() == [] and contained_items(d, i.limit(0)).collect() == []
