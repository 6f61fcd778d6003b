"""From raw documents to token ids, five stages, each on all that the last one kept.

STAGES are (name, function) pairs; a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written and read again as the next one's docs. All
but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.byte_bpe import encode
from tidemark.llm.common import staged
from tidemark.llm.exact_dedup import distinct_documents
from tidemark.llm.langid import UNKNOWN, fit_profiles, held_out, identified, least_score
from tidemark.llm.mixing import mixed_documents
from tidemark.llm.near_dedup import distinct_enough

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
MOST_EPOCHS = 2.0


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the profiles know: those without letters go, and those no
    closer to any profile than chance, by a bound that grows with the text."""
    profiles = fit_profiles(docs.where(~held_out()))
    named = identified(docs, profiles)
    return named.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score(profiles))).select("doc.*")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return distinct_documents(docs, keep="largest")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked texts the one with the smallest doc_id."""
    return distinct_enough(docs, k=SHINGLE_WORDS, percent=SIMILAR_PERCENT)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, small sources up to MOST_EPOCHS times."""
    return mixed_documents(docs, max_epochs=MOST_EPOCHS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids per document, and digests of them and of what they decode to."""
    return encode(docs, RANKS, decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language ID", known_language),
    ("exact dedup", without_copies),
    ("MinHash near-dedup", without_near_copies),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", encoded),
]

# Hypervector profiles and merges have no SQL form; tests/llm/test_corpus_pipeline.py holds
# the rows against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES):
            docs = staged(docs, f"stage-{i}")
    return docs
