"""A corpus from raw documents: language, exact and near copies, benchmark leaks, tokens.

Each stage takes what the one before has kept, written as Parquet and read again,
and all but the last return the columns of ``documents``.  Every stage works on all
rows and whole texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import block_dedup, decontam, langid, omh
from tidewire.llm._common import Scratch, fresh, read_table
from tidewire.llm.queries import token_digests

#: Documents stay if their language has at least this calibrated probability.
LANGUAGE_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those of no certain language; the label is not compared.

    If no document has a label, no language can be learned, and all with a letter stay.
    """
    lang, score = fresh(docs, "__lang"), fresh(docs, "__score")
    model = langid.fit(docs)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = langid.with_language(docs, model, "text", lang, score)
    keep = (F.col(lang) != langid.UNDETERMINED) & (F.col(score) >= LANGUAGE_SCORE)
    return found.where(keep).select(*docs.columns)


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays."""
    return block_dedup.drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates, the document with the least id stays."""
    return omh.drop_near_copies(docs)


def without_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item to 0.8 or more of its shingles."""
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def sentencepiece_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of what is left."""
    return token_digests(docs)


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", without_exact_copies),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark_leaks),
    ("sentencepiece", sentencepiece_tokens),
]

#: Language identification and the tokens are no SQL; the tests compare ``run`` with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name, "snappy")
    return docs
