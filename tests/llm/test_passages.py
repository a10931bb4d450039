import hashlib
import random
import tracemalloc

import numpy as np
import pytest
from strata.llm import anchors, passages
from strata.llm.common import mix64
from strata.llm.queries import op10_repeated_passages


def brute(docs, length=50):
    """(doc_id, n_bytes, n_removed, n_spans, kept) by the first document of every string."""
    first = {}
    for d, t in docs:
        b = (t or "").encode()
        if d is not None:
            for i in range(len(b) - length + 1):
                s = b[i:i + length]
                first[s] = min(d, first.get(s, d))
    out = []
    for d, t in docs:
        b = (t or "").encode()
        gone = [False] * len(b)
        if d is not None:
            for i in range(len(b) - length + 1):
                if first[b[i:i + length]] < d:
                    gone[i:i + length] = [True] * length
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def run(df, **kw):
    got = passages.remove_passages(df, **kw).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got), key=repr)


def test_query_against_brute_force(spark, sf_small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in op10_repeated_passages(spark, sf_small).collect()), key=repr)
    assert got == brute(docs)
    assert sum(r[2] for r in got) > 0


@pytest.mark.parametrize("seed", [1, 2])
def test_mutated_copies(spark, seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("ab é\n") for _ in range(400)) for _ in range(3)] + ["a" * 300]
    docs = [(5, None), (6, ""), (None, base[0]), (9, base[1]), (9, base[1]), (9, base[2])]
    for k in range(60):
        t = list(rnd.choice(base))
        for _ in range(rnd.randrange(6)):
            t[rnd.randrange(len(t))] = rnd.choice("xyzé")
        a = rnd.randrange(100)
        docs.append((100 - k, "".join(t[a:a + rnd.randrange(30, 400)])))
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, n_bytes string").repartition(3)
    assert run(df) == brute(docs)


def test_empty_table_keeps_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    out = passages.remove_passages(df)
    assert out.columns == ["doc_id", "lang", "kept", "n_bytes", "n_removed", "n_spans"] and out.count() == 0


def in_process(docs, length=50, buckets=3, hot=None):
    """All steps on plain rows, dealt by bucket and kind like the shuffles: removed bytes by document, and kinds seen."""
    import pyarrow as pa

    def dealt(batches):
        rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: (r["bucket"], r["kind"]))
        kinds.update(r["kind"] for r in rows)
        for r in rows:
            yield pa.RecordBatch.from_pylist([r])

    kinds = set()
    cutter = passages._Cutter(length, length * 2 // 5)
    rows = [(d, t.encode()) for d, t in docs]
    # blocks of few documents, like several map tasks
    blocks = [rows[i:i + 1500] for i in range(0, len(rows), 1500)]
    cut = passages.cut_units(cutter, buckets, *([hot] if hot else []))
    units = [b for block in blocks for b in cut(iter([pa.RecordBatch.from_pylist([{"doc_id": d, "text": t} for d, t in block])]))]
    settled = [r for b in passages.settle_units(cutter, buckets)(dealt(units)) for r in b.to_pylist()]
    press = passages.zstandard.ZstdCompressor()
    texts = [{"kind": passages.TEXT, "bucket": int(passages._doc_bucket(passages.np.array([d]), buckets)[0]),
              "blob": press.compress(t), "doc_id": d} for d, t in rows]
    ends = pa.RecordBatch.from_pylist(texts + [{**r, "doc_id": None} for r in settled if r["kind"] == passages.ENDS])
    matched = passages.match_ends(cutter, buckets)(dealt(list(passages.cut_ends(cutter, buckets)(dealt([ends])))))
    marks = [r for r in settled if r["kind"] == passages.MARKS] + [r for b in matched for r in b.to_pylist()]
    marks = passages.np.concatenate([passages._load(r["blob"], passages._MARK)[0] for r in marks])
    gone = {d: [False] * len(t) for d, t in rows}
    for d, t in rows:
        found = passages._Marked.check(cutter, [t], [marks[marks["doc"] == d]])
        for m, a, b in zip(found.marks, found.lo.tolist(), found.hi.tolist()):
            a, b = a + (0 if m["lo"] == passages._WHOLE else int(m["lo"])), b if m["hi"] == passages._WHOLE else a + int(m["hi"])
            gone[d][a:b] = [True] * (b - a)
    return gone, kinds


def test_one_passage_in_thousands_of_documents(spark, monkeypatch):
    """Edge anchors of a shared banner have a different unit in every document: they fill no index."""
    from strata.llm import rlbwt
    rnd = random.Random(7)
    banner = "".join(rnd.choice("abcdefgh ") for _ in range(130))

    def other():
        return "".join(rnd.choice("ijklmnop ") for _ in range(rnd.randrange(30, 90)))

    docs = [(d, other() + banner + other()) for d in range(6000)]
    rnd.shuffle(docs)
    want = brute(docs)
    assert sum(r[2] for r in want) >= 5999 * 130
    sizes = []

    class Watched(rlbwt.RunLengthIndex):
        def __init__(self, strings, owners, length):
            sizes.append(sum(map(len, strings)))
            super().__init__(strings, owners, length)

    monkeypatch.setattr(rlbwt, "RunLengthIndex", Watched)
    for hot in (None, 10 ** 9):  # hot in a map task's block; only in the bucket
        sizes.clear()
        gone, kinds = in_process(docs, hot=hot)
        assert sorted((d, sum(g)) for d, g in gone.items()) == sorted((r[0], r[2]) for r in want)
        assert max(sizes, default=0) <= passages._BLOCK
        assert passages.WINDOWS in kinds and (passages.HOT_UNITS in kinds) == (hot is None)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert run(df) == want


def test_hot_anchors_of_mutated_copies():
    rnd = random.Random(3)
    base = "".join(rnd.choice("ab é\n") for _ in range(400))
    docs = []
    for k in range(300):
        t = list(base)
        for _ in range(rnd.randrange(8)):
            t[rnd.randrange(len(t))] = rnd.choice("xyzé")
        docs.append((1000 - k, "".join(t[rnd.randrange(100):])))
    want = sorted((r[0], r[2]) for r in brute(docs))
    for hot in (2, 40):
        gone, kinds = in_process(docs, hot=hot)
        assert sorted((d, sum(g)) for d, g in gone.items()) == want and passages.WINDOWS in kinds


def test_marks_of_a_document_are_found_without_copying_those_of_others():
    import tracemalloc

    import numpy as np
    import pyarrow as pa
    marks = np.zeros(200_000, passages._MARK)
    marks["doc"] = np.arange(200_000)[::-1] // 3
    marks["pos"] = np.arange(200_000)
    _, of = passages._marks_of([{"blob": pa.scalar(passages._dump(marks))}])
    tracemalloc.start()
    got = [of(doc)["pos"].tolist() for doc in (0, 7, 66_666, 70_000, None)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == [[199_997, 199_998, 199_999], [199_976, 199_977, 199_978], [0, 1], [], []]
    assert peak < 100_000


def test_hashes_of_substrings_by_their_formula():
    data = np.random.default_rng(5).integers(0, 256, 200_000).astype(np.uint8)
    source = anchors.Bytes(data)
    table, base, inverse = ([int(x) for x in anchors._TABLE], int(anchors._BASE), int(anchors._INVERSE))
    for start, end in [(0, 0), (0, 7), (65_530, 65_540), (65_536, 65_586), (131_000, 131_200), (199_990, 200_000)]:
        total = sum(table[data[i]] * pow(inverse, i, 1 << 64) for i in range(start, end))
        want = mix64(np.array([total * pow(base, start, 1 << 64) % (1 << 64)], np.uint64))
        assert source.hashes(np.array([start]), np.array([end])) == want
    assert np.array_equal(anchors._UP.first(70_000), anchors._UP.at(np.arange(70_000)))


def test_long_data_leaves_no_tables_behind():
    """Python workers are used again: what a large bucket made them keep added to the memory of all later tasks."""
    anchors.Bytes(np.zeros(10, np.uint8))
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    anchors.Bytes(np.zeros(3_000_000, np.uint8))
    kept = tracemalloc.get_traced_memory()[0] - before
    tracemalloc.stop()
    assert kept < 1 << 20
