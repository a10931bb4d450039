import math
import random

import numpy as np
from strata.llm.queries import op5_toxicity
from strata.llm.toxicity import fit_logistic, learn, score


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op5_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [(labels[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in labels]
    pos, neg = [s for y, s in held if y], [s for y, s in held if not y]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > 0.9


def test_swaps_take_weight_off_group_names(spark):
    rows = [(i, f"the {'muslim' if i % 2 else 'christian'} neighbour said {'awful' if i % 2 and i % 3 else 'good'} word{i % 7}",
             int(bool(i % 2 and i % 3))) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    neutral = "a muslim neighbour sang"
    plain, fair = learn(df, swap_weight=0.0), learn(df, swap_weight=10.0)
    assert abs(fair.weights["muslim"] - fair.weights["christian"]) < 0.2 * abs(plain.weights["muslim"] - plain.weights["christian"])
    assert fair.score(neutral) < plain.score(neutral)
    assert fair.score("awful") > 0.5


def test_defined_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, toxic int")
    model = learn(empty)
    assert model.score("") == 0.5 and model.weights == {}
    one = learn(spark.createDataFrame([(1, "a", 0), (2, None, 0), (3, "x", None)], "doc_id long, text string, toxic int"))
    out = score(spark.createDataFrame([(1, None, "s"), (1, None, "s"), (2, "z " * 50_000, None)], "doc_id long, text string, score string"),
                one).collect()
    assert len(out) == 3 and all(r.predicted == 0 and 0 < r.score < 0.5 for r in out)


def plain_loss(w, bias, rows, labels, swaps, ridge, swap_weight):
    loss = ridge / 2 * sum(x * x for x in w)
    for row, y in zip(rows, labels):
        z = bias + sum(w[f] for f in row)
        loss += (math.log1p(math.exp(-z)) if y else math.log1p(math.exp(z))) / len(rows)
    for gone, come in swaps:
        loss += swap_weight * (sum(w[f] for f in come) - sum(w[f] for f in gone)) ** 2 / len(swaps)
    return loss


def test_fit_is_the_least_plain_loss():
    rnd = random.Random(3)
    rows = [np.array(sorted(rnd.sample(range(6), rnd.randrange(4))), np.int64) for _ in range(200)]
    labels = np.array([float(rnd.random() < (0.8 if 0 in r else 0.3 if 1 in r else 0.1)) for r in rows])
    swaps = [([0], [1]), ([2, 3], [4]), ([5], [])]
    for swap_weight in (0.0, 0.5):
        w, bias = fit_logistic(rows, labels, swaps, 6, ridge=1e-2, swap_weight=swap_weight, steps=3000)
        at = [*w, bias]

        def loss(x):
            return plain_loss(x[:-1], x[-1], rows, labels, swaps, 1e-2, swap_weight)

        for k in range(len(at)):  # the loss is convex: no slope means the least
            up, down = list(at), list(at)
            up[k] += 1e-4
            down[k] -= 1e-4
            assert abs(loss(up) - loss(down)) / 2e-4 < 1e-3
