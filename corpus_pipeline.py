"""The corpus pipeline: documents in, token ids out.

1. ``language``   documents without a language (no letters) go.
2. ``exact``      one of the documents with the same text stays.
3. ``near``       one document of each group of near-duplicates (0.8 of the shingles) stays.
4. ``mix``        documents are repeated or left out, so that sources reach
                  their target weights; a repeated document is repeated rows.
5. ``encode``     whole texts become token ids: doc_id, n_tokens, ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet to the shared folder and reads again for the next stage: a
lost executor costs the running stage's tasks only.  Every stage but the last
returns the columns of ``documents`` as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import bpe, exact_dedup, lang_id, mixing, near_dedup
from lodestar.llm.common import fold, shared_folder, table

TOKENIZER = "byte_bpe_50k.json"
NEAR = 80  # per cent; op5_near_dedup's 85 holds for that query only


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lang_id.with_language(docs, lang_id.learn(docs.where(fold(F.col("doc_id"), 5) != 0)))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(docs, least=NEAR)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("language", language), ("exact", exact), ("near", near), ("mix", mix), ("encode", encode)]

# Viterbi over learned scores, the random sample and BPE are beyond SQL; the
# stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
