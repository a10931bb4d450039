"""One query per operator over the driver tables, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_path
from . import (bpe, containment, fingerprints, langid, licenses, merkle, neardup, packing, passages, ranked, toxicity, warc,
               wrappers)
from .common import documents, pages, staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@register
def op3_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = F.coalesce(langid.remainder("doc_id", 3) == 1, F.lit(False))
    profiles = langid.learn_profiles(docs.where(langid.remainder("doc_id", 3) != 1))
    return langid.predict(docs.select("doc_id", "text", held_out.alias("held_out")), profiles).drop("text")


#: Limits of a sequence beside its 4096 tokens: all three bind somewhere in the corpus (README).
PACKING = {"max_segments": 32, "max_loss_tokens": 3840, "loss_tokens": "loss_tokens"}


def with_loss(docs: DataFrame) -> DataFrame:
    """Documents with ``loss_tokens``: what stands before a document's last n_chars / 5 tokens is taken for its
    prompt and bears no loss (about half of the tokens do; without n_chars all do)."""
    chars = F.col("n_chars") if "n_chars" in docs.columns else F.lit(None)
    return docs.withColumn("loss_tokens", F.floor(chars / 5).cast("long"))


@register
def op6_vector_packing(spark, sf_dir):
    pieces = packing.pack_documents(with_loss(documents(spark, sf_dir)), tokenizer_path(), **PACKING)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


@register
def op7_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(documents(spark, sf_dir), shingle=4, percent=80)


ORACLE_SQL["op7_near_duplicates"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE
      WHEN len(w) = 0 THEN []
      WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM words),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sets s JOIN least l USING (doc_id)
"""


@register
def op10_repeated_passages(spark, sf_dir):
    cut = passages.remove_passages(documents(spark, sf_dir).select("doc_id", "text"), length=50)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "benchmark"))


@register
def op9_benchmark_containment(spark, sf_dir):
    return containment.contained_items(documents(spark, sf_dir), benchmark(spark, sf_dir), shingle=5, percent=80)


ORACLE_SQL["op9_benchmark_containment"] = r"""
WITH texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
words AS (
  SELECT side, id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM texts),
sets AS (
  SELECT side, id, unnest(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))))
    AS shingle
  FROM words WHERE len(w) >= 5
  UNION ALL
  SELECT 'b', id, array_to_string(w, ' ') FROM words WHERE side = 'b' AND len(w) BETWEEN 1 AND 4
  UNION ALL
  SELECT DISTINCT 'd', d.id, array_to_string(d.w[i:i + n - 1], ' ')
  FROM (SELECT DISTINCT len(w) AS n FROM words WHERE side = 'b' AND len(w) BETWEEN 1 AND 4) s,
       (SELECT id, w, unnest(range(1, len(w) + 1)) AS i FROM words WHERE side = 'd') d
  WHERE i + n - 1 <= len(d.w)),
items AS (SELECT id, count(*) AS n FROM sets WHERE side = 'b' GROUP BY id),
pairs AS (
  SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_shared
  FROM sets d JOIN sets b ON d.side = 'd' AND b.side = 'b' AND d.shingle = b.shingle GROUP BY ALL)
SELECT p.doc_id, p.item_id, i.n AS n_item_shingles, p.n_shared, p.n_shared / i.n AS containment
FROM pairs p JOIN items i ON i.id = p.item_id WHERE 100 * p.n_shared >= 80 * i.n
"""


@register
def op2_weighted_fingerprints(spark, sf_dir):
    return fingerprints.fingerprint_neighbours(documents(spark, sf_dir), shingle=5)


@register
def op5_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = F.coalesce(langid.remainder("doc_id", 5) == 0, F.lit(False))
    labels = spark.read.parquet(table_path(sf_dir, "labels")).where(langid.remainder("doc_id", 5) != 0) \
        .where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # the rows to learn from are chosen before their texts are fetched: at most this many ids are broadcast
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(20_000)
    model = toxicity.learn(docs.join(F.broadcast(chosen), "doc_id"), max_rows=20_000)
    return toxicity.score(docs.withColumn("held_out", held_out), model).drop("text")


@register
def op8_license_digests(spark, sf_dir):
    return licenses.scan(documents(spark, sf_dir), licenses.known_table(spark))


ORACLE_SQL["op8_license_digests"] = licenses.oracle()


@register
def op1_warc_index(spark, sf_dir):
    return warc.round_trip(pages(spark, sf_dir), min_bytes=0)


@register
def op4_wrapper_extraction(spark, sf_dir):
    table = pages(spark, sf_dir).select("page_id", "url", "html")
    return wrappers.extract(table, staged(wrappers.learn_wrappers(table), "wrappers"))


@register
def op11_merkle_manifest(spark, sf_dir):
    docs = documents(spark, sf_dir)

    def leaf(text):
        return merkle.row_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    tampered = F.coalesce(langid.remainder("doc_id", 5) == 0, F.lit(False)) & F.col("text").isNotNull()
    found = F.when(tampered, leaf(merkle.lowered(F.col("text"))))  # null: as the leaf
    rows = merkle.manifest(docs, "source", ["doc_id"], leaf(F.col("text")), [F.col("doc_id"), found.alias("found")])
    again = merkle.folded(F.coalesce("found", "leaf"), F.col("path"))
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                       again.alias("folded_root"), (again == F.col("root")).alias("verified"))


ORACLE_SQL["op11_merkle_manifest"] = r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, source, text,
    coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || CAST(doc_id AS VARCHAR), '-')
    || coalesce(octet_length(encode(source)) || ':' || source, '-')
    || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
    || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || CAST(n_chars AS VARCHAR), '-') AS head,
    xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
        lambda i: CAST(ascii(substring(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT))), lambda c, b:
      list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k:
        CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 5 = 0 AS tampered
  FROM documents),
leaves AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos,
    sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(octet_length(encode(text)) || ':' || CASE WHEN tampered
      THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS found
  FROM fields),
up AS (
  SELECT source, 0 AS level, list(leaf ORDER BY doc_id) AS nodes FROM leaves GROUP BY source
  UNION ALL
  SELECT source, level + 1, list_transform(range(0, (len(nodes) + 15) // 16),
    lambda i: sha256(array_to_string(nodes[i * 16 + 1:i * 16 + 16], ''))) FROM up WHERE len(nodes) > 1),
depths AS (SELECT source, max(level) AS depth FROM up GROUP BY source),
tops AS (
  SELECT u.source, u.nodes[1] AS subroot, d.depth, row_number() OVER (ORDER BY encode(u.source) NULLS FIRST) - 1 AS pos
  FROM up u JOIN depths d ON u.source IS NOT DISTINCT FROM d.source AND u.level = d.depth),
above AS (
  SELECT 0 AS level, list(subroot ORDER BY pos) AS nodes FROM tops
  UNION ALL
  SELECT level + 1, list_transform(range(0, (len(nodes) + 15) // 16),
    lambda i: sha256(array_to_string(nodes[i * 16 + 1:i * 16 + 16], ''))) FROM above WHERE len(nodes) > 1),
root AS (SELECT nodes[1] AS root FROM above WHERE len(nodes) = 1),
steps AS (
  SELECT l.doc_id, u.level AS step, l.pos >> CAST(4 * u.level AS BIGINT) AS i, u.nodes
  FROM leaves l JOIN up u ON l.source IS NOT DISTINCT FROM u.source WHERE len(u.nodes) > 1
  UNION ALL
  SELECT l.doc_id, t.depth + a.level, t.pos >> CAST(4 * a.level AS BIGINT), a.nodes
  FROM leaves l JOIN tops t ON l.source IS NOT DISTINCT FROM t.source, above a WHERE len(a.nodes) > 1),
sides AS (
  SELECT doc_id, step, array_to_string(nodes[i // 16 * 16 + 1:i], '') AS before,
    array_to_string(nodes[i + 2:i // 16 * 16 + 16], '') AS after
  FROM steps),
proofs AS (
  SELECT doc_id, sha256(string_agg(before || after, '' ORDER BY step)) AS proof, count(*) AS n FROM sides GROUP BY doc_id),
fold AS (
  SELECT doc_id, 0 AS step, found AS node FROM leaves
  UNION ALL
  SELECT f.doc_id, f.step + 1, sha256(s.before || f.node || s.after)
  FROM fold f JOIN sides s ON f.doc_id = s.doc_id AND f.step = s.step)
SELECT l.doc_id, l.leaf, t.subroot, r.root, coalesce(p.proof, sha256('')) AS proof_sha256, f.node AS folded_root,
  f.node = r.root AS verified
FROM leaves l JOIN tops t ON l.source IS NOT DISTINCT FROM t.source JOIN root r ON true
LEFT JOIN proofs p ON l.doc_id = p.doc_id
JOIN fold f ON l.doc_id = f.doc_id AND f.step = coalesce(p.n, 0)
"""


@register
def op13_byte_bpe(spark, sf_dir):
    import public_tokenizers
    ranks = bpe.Ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded = bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), ranks).drop("text")
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return bpe.decode(coded, ranks).select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                                           F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@register
def op12_ranked_search(spark, sf_dir):
    return ranked.search(documents(spark, sf_dir), benchmark(spark, sf_dir), k=10)


ORACLE_SQL["op12_ranked_search"] = r"""
WITH texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
terms AS (
  SELECT side, id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM texts),
postings AS (SELECT id, term, count(*) AS tf FROM terms WHERE side = 'd' GROUP BY id, term),
lengths AS (SELECT id, CAST(sum(tf) AS BIGINT) AS n FROM postings GROUP BY id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM lengths),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM postings, totals GROUP BY term, docs),
scores AS (
  SELECT q.id AS item_id, p.id AS doc_id, CAST(sum(w.w * ((1000000000 * p.tf)
    // (1000 * p.tf + 8 * (100 - 90 + ((90 * l.n * t.docs) // t.words))))) AS BIGINT) AS score
  FROM (SELECT DISTINCT id, term FROM terms WHERE side = 'b') q
  JOIN postings p USING (term) JOIN weights w USING (term) JOIN lengths l ON l.id = p.id, totals t
  GROUP BY q.id, p.id),
ranks AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= 10
"""
