"""The registered queries of the training-data operators, with their SQL where SQL can
express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, embedding_dedup, fingerprints, minhash_dedup, mixing, quality, sharding, source_audit, substring_dedup, suffix_dedup, toxicity, training_order, whitening
from tidemark.llm.common import read
from tidemark.llm.oracle import LINK_TEXTS_SQL, STRIP_SQL


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learnt from three quarters of the labels."""
    return quality.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole corpus mixed to square-root source weights, in training order."""
    return mixing.mix(read(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings linked with those of their label at cosine 0.98 or more."""
    return embedding_dedup.link_vectors(read(spark, sf_dir, "embeddings"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 100-byte strings that start earlier, as digests."""
    return suffix_dedup.repeated_strings(read(spark, sf_dir, "documents"))


def op5_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token sequences in shard files, each in its keyed global slot, read back."""
    return training_order.materialise(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores and spans of all documents, learnt from two thirds of the labels."""
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded, as digests."""
    return bpe.encode_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near-equal bytes, equal texts together."""
    return sharding.shard_documents(read(spark, sf_dir, "documents"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents linked at five-word shingle similarity 0.75 or more."""
    return minhash_dedup.link_documents(read(spark, sf_dir, "documents"))


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k fingerprints of all documents and of their edited texts."""
    return fingerprints.fingerprint_edits(read(spark, sf_dir, "documents"))


def op11_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of 20-word windows that start earlier, as digests."""
    return substring_dedup.strip_repeated(read(spark, sf_dir, "documents"), texts=False)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the leading whitening directions."""
    return whitening.whiten_vectors(read(spark, sf_dir, "embeddings"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language, and each source's leading terms."""
    return source_audit.audit_sources(read(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_quality, op2_mix, op3_embedding_dedup, op4_suffix_dedup, op5_training_order, op6_toxicity, op7_bpe, op8_sharding, op9_minhash, op10_fingerprint, op11_substring, op12_whitening, op13_divergence)}

LLM_ORACLE: dict[str, str] = {
    "op2_mix": mixing.MIX_SQL,
    "op3_embedding_dedup": embedding_dedup.LINK_SQL,
    "op9_minhash": LINK_TEXTS_SQL,
    "op11_substring": STRIP_SQL,
    "op13_divergence": source_audit.AUDIT_SQL,
}
