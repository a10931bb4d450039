"""Training-corpus preparation: an ordered list of stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)``, works on every row that the stage
before it kept, and returns a DataFrame; ``run`` writes each result as Parquet
in the shared folder and reads it back as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import containment, langid, neardup, packing, passages
from strata.llm.common import documents, staged
from strata.llm.queries import PACKING, benchmark, tokenizer_path, with_loss

def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter and those far from every learned language: with a score below what
    the learning rows' own scores allow."""
    learning = langid.remainder("doc_id", 3) != 1
    profiles = langid.learn_profiles(docs.where(learning))
    least = langid.least_score(langid.predict(docs.where(learning & docs.lang.isNotNull()).select("text"), profiles))
    judged = langid.predict(docs, profiles)
    return judged.where((judged.lang_pred != langid.UNDETERMINED) & (judged.score >= least)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group: that with the smallest id (five-word shingles, similarity 0.8)."""
    groups = neardup.near_duplicates(docs, shingle=5, percent=80)
    dropped = staged(groups.where("not kept").select("doc_id").distinct(), "corpus-dropped")
    return docs.hint("merge").join(dropped, "doc_id", "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 50 bytes or more that an earlier document has; what is left of a cut
    character at either end of a cut goes too. ``n_chars`` of a cut text is counted anew."""
    had_text = "repeated_passages_had_text"
    cut = passages.remove_passages(docs.withColumn(had_text, F.col("text").isNotNull()), length=50, whole_chars=True)
    kept = F.col("kept").cast("string")
    changed = F.col("n_removed") > 0
    cut = cut.withColumn("text", F.when(F.col(had_text), kept))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return containment.without_items(docs, benchmark(spark, sf_dir), shingle=5, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of all documents that are left."""
    return packing.pack_documents(with_loss(docs), tokenizer_path(), **PACKING)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Tokenization, profiles and packing are not expressible in SQL; tests/llm holds the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
