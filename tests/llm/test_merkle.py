import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from strata.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i:i + fanout]) for i in range(0, len(below), fanout)])
    return levels


def siblings(levels, at, fanout):
    out = []
    for nodes in levels[:-1]:
        first = at // fanout * fanout
        out.append(("".join(nodes[first:at]), "".join(nodes[at + 1:first + fanout])))
        at //= fanout
    return out


def brute(rows, fanout):
    """(doc_id, leaf, subroot, root, path) of (doc_id, source, text)."""
    groups = defaultdict(list)
    for d, s, t in rows:
        groups[s].append(((d is not None, d), h(field(d), field(s), field(t)), d))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([leaf for _, leaf, _ in sorted(groups[s])], fanout) for s in names}
    top = climb([trees[s][-1][0] for s in names], fanout)
    out = []
    for k, s in enumerate(names):
        for at, (_, leaf, d) in enumerate(sorted(groups[s])):
            path = siblings(trees[s], at, fanout) + siblings(top, k, fanout)
            out.append((d, leaf, trees[s][-1][0], top[-1][0], path))
    return sorted(out, key=repr)


def rows_of(counts):
    rows = [(None, None, None), (None, "hot", "x"), (5, "é", "Ä" * 3), (6, "z", ""), (7, "", "empty name"), (8, "long", "Ab " * 200_000)]
    rows += [(1000 + i, "hot", f"Text {i}") for i in range(counts)]
    rows += [(3, "twice", "same"), (3, "twice", "same"), (3, "twice", "other")]
    return rows + [(100 + i, f"s{i:03d}", "One") for i in range(20)]


@pytest.mark.parametrize("fanout,counts", [(2, 40), (3, 75), (16, 600)])
def test_against_plain_trees(spark, monkeypatch, fanout, counts):
    monkeypatch.setattr(merkle, "FANOUT", fanout)
    monkeypatch.setattr(merkle, "BLOCK", fanout * fanout)
    rows = rows_of(counts)
    # names that the operator uses itself, and one that it doesn't read
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, source string, text string, hash string, grp int")
    leaf = merkle.row_digest(F.col("doc_id"), F.col("source"), F.col("text"))
    out = merkle.manifest(df.repartition(5), "source", ["doc_id"], leaf, ["doc_id"])
    out = out.select("*", merkle.folded(F.col("leaf"), F.col("path")).alias("again"),
                     merkle.proof_digest(F.col("path")).alias("proof")).collect()
    got = sorted(((r.doc_id, r.leaf, r.subroot, r.root, [tuple(p) for p in r.path]) for r in out), key=repr)
    assert got == brute(rows, fanout)
    assert all(r.again == r.root for r in out)
    assert all(r.proof == h(*(a + b for a, b in r.path)) for r in out)


def test_a_changed_leaf_gives_another_root(spark):
    rows = [(i, f"s{i % 3}", f"Text {i}" if i % 2 else "text") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = merkle.row_digest(merkle.lowered(F.col("text")))
    out = merkle.manifest(df, "source", ["doc_id"], merkle.row_digest(F.col("text")), ["doc_id", found.alias("found")])
    bad = out.where(merkle.folded(F.col("found"), F.col("path")) != F.col("root")).select("doc_id").collect()
    assert sorted(r.doc_id for r in bad) == [i for i in range(60) if i % 2]


def test_only_ascii_letters_are_lowered(spark):
    got = spark.createDataFrame([("AZ Ä İ",), (None,)], "t string").select(merkle.lowered(F.col("t"))).collect()
    assert [r[0] for r in got] == ["az Ä İ", None]


def test_one_row_and_no_rows(spark):
    schema = "doc_id long, source string, text string"
    one = spark.createDataFrame([(1, None, "a")], schema)
    leaf = merkle.row_digest(F.col("text"))
    row, = merkle.manifest(one, "source", ["doc_id"], leaf, ["doc_id"]).collect()
    assert row.leaf == row.subroot == row.root == h("1:a") and row.path == []
    assert merkle.manifest(spark.createDataFrame([], schema), "source", ["doc_id"], leaf, ["doc_id"]).collect() == []
