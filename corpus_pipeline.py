"""Corpus pipeline: language ID, SimHash near-dedup, decontamination, secret masking, SentencePiece ids.

Each stage takes (spark, docs, sf_dir) and returns what it keeps with the
columns of ``documents``; the last one returns every kept document with its
piece ids. Stages read all rows their predecessor kept, learn only from those,
and work for empty tables, null texts and null ids (see the operators).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from eventide.llm import decontaminate, langid, pieces, secrets, simhash
from eventide.llm.common import read_table
from eventide.llm.queries import PIECES
from eventide.session import checkpoint_dir, configure


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a known language over enough of their letters."""
    return langid.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group, that of the smallest id, then text hash (4-word shingles, 4 bits)."""
    return simhash.keep_first(docs, k=4, max_bits=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked."""
    return secrets.redact(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids of every document."""
    out = pieces.encode(docs, PIECES)
    return out.select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_masking", mask_secrets),
    ("sentencepiece", encode_pieces),
]

#: Languages, masked spans and piece ids have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    configure(spark)
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{n}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
