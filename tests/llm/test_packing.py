import os
import subprocess
import sys
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from strata.llm.packing import WordEncoder, pack_documents
from strata.llm.queries import PACKING, op6_vector_packing, tokenizer_path, with_loss

ODD = ["", " ", "a\nb  c", "İstanbul ΣΑΣ", "étè x́", "it's 'sb don't ...,,", "<|endoftext|> z<|endoftext|>", "ﬁ 12,3 4\t5\x1c6 \xa0 x",
       "日本語。テスト", "ẞtraße ẞ a×b", "foo.bar!!$ $$", "Ǆ ǅ ŉ", "ÉCOLE, Übung; œuvre!", "mail@host.com 10.0.0.1 CC-BY 4.0."]


def whole(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_word_ids_equal_whole_text_ids(spark, sf_small):
    texts = [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").limit(60).collect()] + ODD
    encoder = WordEncoder(tokenizer_path())
    for _ in range(2):  # learned, then remembered
        assert [x.tolist() for x in encoder.encode(pa.array(texts))] == whole(texts)


def check(rows, docs, capacity, segments=None, loss=None):
    """Pieces cover each document once; sequences are gapless and within the limits."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.length, np.frombuffer(bytes(r.ids), np.uint32).tolist(), r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length, r.loss_tokens))
    assert set(pieces) == set(docs)
    for d, ids in docs.items():
        at = 0
        for start, length, got, total in sorted(pieces[d]):
            assert (start, total) == (at, len(ids)) and got == ids[start:start + length] and length > 0
            at += length
        assert at == len(ids)
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity and (segments is None or len(parts) <= segments)
        assert loss is None or sum(p[2] for p in parts) <= loss
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


def test_query_round_trip(spark, sf_small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    ids = dict(zip(docs, ([*x, 2] for x in whole(docs.values()))))
    rows = pack_documents(spark.read.parquet(f"{sf_small}/documents.parquet"), tokenizer_path()).collect()
    assert check(rows, ids, 4096) == 0
    limited = with_loss(spark.read.parquet(f"{sf_small}/documents.parquet"))
    rows = pack_documents(limited, tokenizer_path(), **PACKING).collect()
    check(rows, ids, 4096, PACKING["max_segments"], PACKING["max_loss_tokens"])
    got = op6_vector_packing(spark, sf_small).collect()
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in got) == sorted(
        (r.doc_id, r.start, r.length, zlib.crc32(bytes(r.ids))) for r in rows)


@pytest.mark.parametrize("segments,loss", [(3, 64), (100, 20), (1, 64)])
def test_limits(spark, segments, loss):
    data = [(i, "word " * (i % 37), i % 11, "clash") for i in range(200)]
    df = spark.createDataFrame(data, "doc_id long, text string, answer long, ids string").repartition(2)
    ids = {i: [*whole([t])[0], 2] for i, t, _, _ in data}
    rows = pack_documents(df, tokenizer_path(), capacity=64, max_segments=segments, max_loss_tokens=loss,
                          loss_tokens="answer", pool=32).collect()
    check(rows, ids, 64, segments, loss)


def test_nulls_repeats_and_no_rows(spark):
    df = spark.createDataFrame([(1, None), (None, "a b"), (2, "x"), (2, "x"), (3, "")], "doc_id long, text string")
    rows = pack_documents(df.coalesce(1), tokenizer_path()).collect()
    assert sorted((r.doc_id or 0, r.doc_tokens) for r in rows if r.start == 0) == [(0, 3), (1, 1), (2, 2), (2, 2), (3, 1)]
    assert pack_documents(df.limit(0), tokenizer_path()).collect() == []


def test_each_limit_binds_in_the_querys_own_settings(spark):
    """Tiny documents fill the segments, a long one the loss-bearing tokens, others the tokens."""
    tiny = [(i, f"w{i}", 5) for i in range(400)]
    long = [(1000, "one two three " * 12_000, 10**9), (1001, "one two three " * 5_000, 0), (1002, "four " * 300, None)]
    docs = with_loss(spark.createDataFrame(tiny + long, "doc_id long, text string, n_chars long").coalesce(1))
    rows = pack_documents(docs, tokenizer_path(), **PACKING).collect()
    ids = dict(zip([d for d, *_ in tiny + long], ([*x, 2] for x in whole([t for _, t, _ in tiny + long]))))
    check(rows, ids, 4096, PACKING["max_segments"], PACKING["max_loss_tokens"])
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(r)
    assert max(len(x) for x in by.values()) == PACKING["max_segments"]
    assert max(sum(r.loss_tokens for r in x) for x in by.values()) == PACKING["max_loss_tokens"]
    assert max(sum(r.length for r in x) for x in by.values()) == 4096
    plain = pack_documents(docs, tokenizer_path()).collect()
    assert {r.sequence_id: r.length for r in plain} != {r.sequence_id: r.length for r in rows}


def test_ids_after_the_memory_was_cleared(monkeypatch):
    monkeypatch.setattr(WordEncoder, "LIMIT", 3)
    encoder = WordEncoder(tokenizer_path())
    for _ in range(3):
        for part in (ODD[:5], ODD[5:]):
            assert [x.tolist() for x in encoder.encode(pa.array(part))] == whole(part)


def test_words_whose_ends_show_in_no_token(monkeypatch):
    encoder = WordEncoder(tokenizer_path())
    encoder.is_end[:] = False
    assert [x.tolist() for x in encoder.encode(pa.array(ODD))] == whole(ODD)


def test_memory_while_new_words_are_learned():
    """Peak of an own process, as a Python worker is one, over many words that the encoder has not met."""
    code = f"""
import random
import pyarrow as pa
from strata.llm.packing import WordEncoder

def peak():
    return int(next(x for x in open('/proc/self/status') if x.startswith('VmHWM')).split()[1]) >> 10

encoder = WordEncoder({tokenizer_path()!r})
rnd = random.Random(1)
words = sorted({{''.join(rnd.choices('abcdefghijklmnopqrstuvwxyz', k=8)) for _ in range(100_000)}})
text = pa.array([' '.join(words)])
encoder.encode(pa.array(['some words']))
before = peak()
encoder.encode(text)
print(peak() - before)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=120,
                         env={**os.environ, "PYTHONPATH": os.pathsep.join(sys.path)})
    assert int(out.stdout) < 90  # MB
