"""The corpus pipeline: five stages over ``documents``, each one operator.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next stage's docs.  All but the last return the
columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import language, line_runs, minhash, mixing, packing
from folio.llm.common import crc_mod, documents, stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; its name replaces ``lang``.  Only
    texts without a letter are rejected: a text in a language without labels
    stays, under the name of the nearest one."""
    model = language.train(docs, learn=crc_mod("doc_id", 3) != 1)
    named = language.predict(docs, model, pred_col="_lang", score_col="_score")
    kept = named.filter(F.col("_lang") != language.UNKNOWN)
    return kept.withColumn("lang", F.col("_lang")).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs."""
    out = line_runs.remove_repeated_runs(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them, a row for each time."""
    out = mixing.mixed_documents(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens in the mix's proportions."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix),
    ("packing", pack),
]

# Classification, sketching and tokenizing cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{k}")
    return docs
