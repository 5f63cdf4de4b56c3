"""Corpus pipeline: stages over the documents table, each written and read again as the next one's input.

1. language_id: learns from the held-in labelled rows and keeps the documents whose language it tells;
   documents without a letter and those under MIN_SCORE go.
2. near_duplicates: documents that link by word shingles form groups; the smallest id of each group stays.
3. repeats: passages that also stand elsewhere are cut out of the texts: runs of 50 words or more covered by strings of 240
   bytes that start anywhere else too (suffix_dedup.PASSAGE and WORDS); documents without a word left go.
4. mixing: the mix decides how often each document is read; one row for each reading, in training order,
   none for documents the mix leaves out.
5. tokens: encodes and decodes every text; one row per document and reading with its ids and digests.

All stages but the last keep the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import language_id, mixing, parity_join, pieces, suffix_dedup
from quarry.llm.common import shared_dir
from quarry.llm.queries import tokenizer

MIN_SCORE = 0.5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    langs, p = language_id.learn(language_id.train_rows(docs), tokenizer())
    found = language_id.identify(docs, langs, p, tokenizer())
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE)).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return parity_join.one_of_each(docs)


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.cleaned(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.readings(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.token_digests(docs, tokenizer())


STAGES = [
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeats", repeat_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: The stages learn, cluster and sort suffixes: SQL cannot express them; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what lies between them is Parquet in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        path = f"{base}/{i}-{name}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
