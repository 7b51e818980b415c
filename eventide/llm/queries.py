"""Registered queries of the numbered operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import centroids, decontaminate, kneser, langid, packing, pieces, repeats, secrets, simhash, tokenfile, \
    trie, warc, weighted
from eventide.llm.common import read_table
from eventide.session import checkpoint_dir

#: Public tokenizer files (their folder can be set in the environment).
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
BYTE_BPE = f"{TOKENIZERS}/byte_bpe_50k.json"
PIECES = f"{TOKENIZERS}/piece_bpe_32k.model"
WORD_BPE = f"{TOKENIZERS}/word_bpe_49k.json"
END_ID = 2
#: Longest n-grams of the language model.
LM_ORDER = 3

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


@query("op1_fingerprints")
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consistent weighted sampling fingerprints of every document and of its edited text."""
    return weighted.with_edits(read_table(spark, sf_dir, "documents"))


@query("op2_revisits", warc.ORACLE)
def op2_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not-modified captures of the pages, resolved against the latest earlier full response."""
    found = warc.resolve(warc.page_captures(read_table(spark, sf_dir, "pages")))
    return found.select("record_id", "url_key", "response_id", "outcome", warc.header_text("headers").alias("headers"))


@query("op3_decontamination")
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, with BM25 score and question and answer overlap."""
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query("op4_secret_scan")
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base patterns and the Markov ratio."""
    found = secrets.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", *[secrets.count_kind("__base", k).alias(f"n_{n}") for k, n in enumerate(secrets.KINDS[:3])],
        F.sha2(secrets.span_text("__base"), 256).alias("base_sha256"), secrets.span_text("__spans").alias("spans"),
        secrets.count_kind("__spans", 3).alias("n_random"))


@query("op5_simhash_dedup")
def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    found = langid.identify(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))


@query("op7_token_files")
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document as the library encodes them, written as directly addressable codes and read back."""
    path = f"{checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    tokenfile.write(read_table(spark, sf_dir, "documents"), path, BYTE_BPE, END_ID, special_text=False)
    return tokenfile.read(spark, path)


@query("op10_sentencepiece")
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document and the text they decode to."""
    tokens = pieces.encode(read_table(spark, sf_dir, "documents").select("doc_id", "text"), PIECES)
    back = pieces.decoded(tokens, PIECES)
    return back.select("doc_id", "n_tokens", "ids_crc32", F.sha2("decoded", 256).alias("decoded_sha256"),
                       (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


@query("op8_substring_dedup", repeats.ORACLE)
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document left after all repeated 35-word windows are removed."""
    out = repeats.remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op9_lm_scoring")
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kneser-Ney trigram and base log-probabilities, and perplexity, of every document."""
    left = langid.remainder("doc_id", 5)
    return kneser.score(read_table(spark, sf_dir, "documents"), left != 1, left == 1, order=LM_ORDER)


@query("op11_centroids", centroids.ORACLE)
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distances and inertia of every vector after 10 rounds with 8 centroids."""
    return centroids.cluster(read_table(spark, sf_dir, "embeddings"))


@query("op12_packing")
def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of at most 2048 tokens."""
    packed = packing.pack(read_table(spark, sf_dir, "documents"), WORD_BPE, end=0)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op13_prefix_trie", trie.ORACLE)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return trie.build(read_table(spark, sf_dir, "conversations"), trie.FORK).drop("digest")
