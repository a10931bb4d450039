import base64
import hashlib
import random

import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from strata.llm import bpe
from strata.llm.queries import op13_byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.Ranks(PATH)


@pytest.fixture(scope="module")
def plain():
    with open(PATH, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def test_the_pattern_is_the_files_own():
    assert bpe.PATTERN == public_tokenizers.PATTERN


TEXT = st.text(st.one_of(st.sampled_from(list("'' \n\t 　stmdrevlaZ19é!?²ßЖ漢🙂́‍\u0085\u001f")), st.characters(exclude_categories=["Cs"])), max_size=40)


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=5))
def test_split_matches_the_pattern(texts):
    assert bpe.split(texts) == [regex.findall(bpe.PATTERN, t) for t in texts]


def test_classes_match_the_library(plain):
    # one text a thousand code points: each between letters, each between digits, and each after a blank
    for first in range(0, 0x30000, 1000):
        codes = [c for c in range(first, first + 1000) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{chr(c)}a 1{chr(c)}1 {chr(c)}-" for c in codes)
        words = bpe.split([text])[0]
        assert [i for w in words for i in plain.encode_ordinary(w)] == plain.encode_ordinary(text), hex(first)


def texts():
    rnd = random.Random(3)
    out = [None, "", " ", "\n\n x", "It's we'll 'tis I'd they've 're'", "x" * 5000, "=" * 3000 + " " * 2000, "\u0001\u0000�",
           "漢字かな交じり文 Привет мир 🙂🙂👩‍👩‍👧", "word " * 30_000, "same text", "same text"]
    out += ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(3000))]
    out += ["".join(chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(160, 0xD000), rnd.randrange(0x1F300, 0x1F700)]))
                    for _ in range(200)) for _ in range(30)]
    return out


@pytest.mark.parametrize("dictionary", [1_000_000, 20, 0])
def test_ids_are_the_librarys_and_decode_to_the_text(spark, ranks, plain, dictionary):
    rows = [(None if i == 5 else i // 2, t, "x", [1]) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string, ids array<int>").repartition(3)
    got = bpe.decode(bpe.encode(df, ranks, dictionary=dictionary), ranks).collect()
    assert len(got) == len(rows)
    for r in got:
        assert list(r.ids) == plain.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode() and r.word == "x"


def test_no_rows(spark, ranks):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(empty, ranks), ranks).collect() == []


def test_a_file_that_is_no_merge_table(tmp_path):
    lines = [base64.b64encode(bytes([b])) + b" %d\n" % b for b in range(256)]
    path = tmp_path / "ranks"
    path.write_bytes(b"".join([*lines, base64.b64encode(b"abc") + b" 256\n"]))
    with pytest.raises(ValueError, match="not the merge"):
        bpe.Ranks(str(path))


def test_query_on_whole_table(spark, sf_small, plain):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = op13_byte_bpe(spark, sf_small).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        text = texts[r.doc_id] or ""
        ids = plain.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
