"""The corpus pipeline: quality rules, quality classifier, near-duplicates, source mixing, tokens.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame; it is written
as Parquet to the cluster's shared folder and read again as the next one's docs. All but the last return the columns
of documents. Nulls, empty texts, repeated rows and empty tables have the results that the operators define.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from barlake.llm import bpe, mixing, nbsvm, rules, simhash
from barlake.llm.common import shared_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the learned decision list."""
    return rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at least 0.3."""
    return nbsvm.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), cut=0.3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 4-word shingles, 4 bits."""
    return simhash.deduplicate(docs, shingle=4, distance=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus; a document occurs as often as the mix takes it, up to twice."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the text decoded from them."""
    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"),
                      outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256"), keep=["doc_id", "lang", "source"])


STAGES = [("quality_rules", quality_rules), ("quality_classifier", quality_classifier),
          ("simhash_near_dedup", near_duplicates), ("mix_sources", mix_sources), ("bpe", tokens)]

#: The models are trained, fingerprints are XXH64 and tokens BPE: SQL expresses the base rules and the mix alone.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each stored and read again."""
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
