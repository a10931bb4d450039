"""Each stage of the pipeline against a plain version of it, on its own input."""

import corpus_pipeline as p
import pytest
from strata.llm import langid
from strata.llm.common import documents, staged
from test_packing import check, whole
from test_passages import brute as brute_passages


def shingles(text, n=5):
    words = text.encode().lower().split()
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())


@pytest.fixture(scope="module")
def stages(spark):
    sf = "/root/testdata/sf0.001"
    docs, out = documents(spark, sf), []
    for name, stage in p.STAGES:
        after = staged(stage(spark, docs, sf), f"test-{name}")
        out.append((docs, after))
        docs = after
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_and_rows(stages):
    assert [n for n, _ in p.STAGES] == ["language_id", "near_duplicates", "repeated_passages", "decontamination", "packing"]
    for before, after in stages[:-1]:
        assert after.columns == before.columns and set(texts(after)) <= set(texts(before))


def test_language_stage_keeps_prose(stages):
    before, after = map(texts, stages[0])
    assert all(any(c.isalpha() for c in t) for t in after.values()) and len(after) > 0.95 * len(before)


def test_one_of_each_group_stays(stages):
    before, after = map(texts, stages[1])
    sets = {d: shingles(t) for d, t in before.items()}
    least = {d: d for d in before}

    def find(d):
        while least[d] != d:
            d = least[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                least[y] = x
    assert set(after) == {d for d in ids if find(d) == d} and len(after) < len(before)
    assert all(after[d] == before[d] for d in after)


def test_passages_are_cut(stages):
    before, after = map(texts, stages[2])
    want = {r[0]: r for r in brute_passages(list(before.items()))}
    assert set(after) == set(before)
    for d, t in after.items():
        assert (t == before[d]) == (want[d][2] == 0)
        assert 0 <= want[d][1] - want[d][2] - len(t.encode()) <= 6 * want[d][3]
    assert all(r.n_chars == len(r.text) for r in stages[2][1].collect() if want[r.doc_id][2])


def test_no_benchmark_item_is_left(spark, stages):
    before, after = map(texts, stages[3])
    items = [shingles(r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    held = {d for d, t in before.items() if any(100 * len(i & shingles(t)) >= 80 * len(i) for i in items if i)}
    assert set(after) == set(before) - held and held


def test_packed_whole(stages):
    docs = texts(stages[4][0])
    ids = dict(zip(docs, ([*x, 2] for x in whole(docs.values()))))
    assert check(stages[4][1].collect(), ids, 4096, 32, 3840) < 0.02 * sum(map(len, ids.values()))


def test_gibberish_and_an_unlearned_language_go(spark):
    import base64
    import random
    rnd = random.Random(4)
    sf = "/root/testdata/sf0.01"
    docs = documents(spark, sf)
    finnish = "tämä on suomenkielinen teksti jossa on monia sanoja ja lauseita sekä pitkiä yhdyssanoja joita muissa kielissä ei ole "
    odd = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n)) for n in (60, 300, 2000)]
    odd += [base64.b64encode(rnd.randbytes(n)).decode() for n in (60, 300, 2000)] + [finnish * 3, finnish * 20, "12 %%", "", None]
    more = spark.createDataFrame([(10**6 + i, t, None, "odd", len(t or "")) for i, t in enumerate(odd)], docs.schema)
    kept = {r.doc_id for r in p.language_id(spark, docs.unionByName(more), sf).collect()}
    lettered = {r.doc_id for r in docs.collect() if r.text and any(c.isalpha() for c in r.text)}
    assert kept == lettered
    assert p.language_id(spark, docs.limit(0), sf).collect() == []


def test_language_scores(spark):
    rows = [(i, "the cat and the dog are in the house " * 3, "en") for i in range(40)] \
        + [(100 + i, "der Hund und die Katze sind in dem Haus " * 3, "de") for i in range(40)]
    known = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = langid.learn_profiles(known)
    new = [(1, "a house and a cat"), (2, "das Haus und der Hund"), (3, None), (4, "12 $$"), (4, "12 $$"), (5, ""), (6, "the " * 50_000)]
    df = spark.createDataFrame([(d, t, "clash") for d, t in new], "doc_id long, text string, score string")
    got = sorted((r.doc_id, r.lang_pred, 0 <= r.score <= 1, r.score == 0) for r in langid.predict(df, profiles).collect())
    assert got == [(1, "en", True, False), (2, "de", True, False), (3, "und", True, True), (4, "und", True, True),
                   (4, "und", True, True), (5, "und", True, True), (6, "en", True, False)]
    nothing = langid.predict(df, langid.learn_profiles(known.limit(0))).collect()
    assert {r.lang_pred for r in nothing} == {"und"} and len(nothing) == 7
    assert langid.predict(df.limit(0), profiles).collect() == []


def test_only_cut_characters_go_with_a_passage(spark):
    """Replacement characters of the input stay; the rest of a character goes at either end of a cut."""
    one, two = "".join(chr(97 + i * i % 26) + str(i) for i in range(30)), "".join(str(i) + chr(97 + i * 7 % 26) for i in range(30))
    rows = [(1, f"{one}é other"), (2, f"é{two}"), (3, f"� a \U0001f600 {one}è b �ĩ{two} €�"), (4, "� short"), (5, None)]
    df = spark.createDataFrame([(d, t, len(t or "")) for d, t in rows], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in p.repeated_passages(spark, df, None).collect()}
    cut = "� a \U0001f600  b � €�"
    assert got == {**{d: (t, len(t or "")) for d, t in rows}, 3: (cut, len(cut))}
