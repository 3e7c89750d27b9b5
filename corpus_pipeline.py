"""The corpus pipeline: raw documents to training tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``.  All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, minhash_dedup, mixing, suffix_dedup, toxicity
from tidemark.llm.common import read, shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold."""
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at five-word shingle similarity 0.75 or more."""
    return minhash_dedup.keep_one(docs).select(*COLUMNS)


def drop_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that also start earlier; n_chars follows."""
    out = suffix_dedup.remove_repeated(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources reach their target weights."""
    return mixing.mix(docs).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token ids, with digests."""
    return bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=True)


STAGES = [
    ("drop_toxic", drop_toxic),
    ("drop_near_duplicates", drop_near_duplicates),
    ("drop_repeated_strings", drop_repeated_strings),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: The stages train models and compare documents, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written to the shared folder."""
    docs = read(spark, sf_dir, "documents")
    at = f"{shared_dir(spark)}/pipeline-{uuid.uuid4()}"
    for i, (name, stage) in enumerate(STAGES):
        out = f"{at}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
