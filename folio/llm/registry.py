"""Queries of the training-data operators and their DuckDB oracles.

Each query is thin: it reads its whole table, applies one operator with
production parameters and derives the contract's columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from folio.llm import (
    embeddings, language, line_runs, main_text, minhash, mixing, packing, periodic_runs, piece_codec, piecewise,
    ranked_search, suffix_runs, toxicity,
)
from folio.llm.common import crc_mod, documents
from folio.llm.oracles import ORACLE_SQL  # noqa: F401  (re-exported)


def op5_main_text(spark, sf_dir):
    """Main text of all pages."""
    return main_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op6_piecewise_fingerprint(spark, sf_dir):
    """Fingerprints of all documents, their edited texts and their neighbours."""
    return piecewise.fingerprint_neighbours(documents(spark, sf_dir))


def op7_suffix_dedup(spark, sf_dir):
    """What is left of all documents without repeated 400-byte strings."""
    return suffix_runs.remove_repeated_strings(documents(spark, sf_dir)).drop("kept")


def op8_minhash_near_dedup(spark, sf_dir):
    """Near-duplicate components of all documents."""
    return minhash.near_duplicates(documents(spark, sf_dir))


def op1_embedding_near_dedup(spark, sf_dir):
    """Links and components of all embeddings."""
    return embeddings.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op2_mixture_packing(spark, sf_dir):
    """Pieces of all documents in windows of 1024 tokens."""
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op3_toxicity(spark, sf_dir):
    """Toxicity of every document; learned from ids whose crc32 mod 5 is not 0."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, learn=crc_mod("doc_id", 5) != 0)
    held = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    return toxicity.predict(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def op4_language_id(spark, sf_dir):
    """Language of every document; learned from ids whose crc32 mod 3 is not 1."""
    docs = documents(spark, sf_dir)
    model = language.train(docs, learn=crc_mod("doc_id", 3) != 1)
    held = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    return language.predict(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op9_line_runs(spark, sf_dir):
    """Line counts and the digest of what is left of every document."""
    out = line_runs.remove_repeated_runs(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"))


def op10_mix_sources(spark, sf_dir):
    """Words that the mix takes of every document."""
    return mixing.taken_words(documents(spark, sf_dir))


def planted_periods(docs):
    """``docs`` with a text made periodic from some word on, where the crc32 of
    the id ends in 0 (operator 11's input)."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    g = F.floor(h / 10)
    rows = docs.select("doc_id", "text", words.alias("_words"), g.alias("_g")).withColumn("_n", F.size("_words"))
    rows = rows.withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")).cast("int"))
    rest = F.col("_n") - F.col("_a")
    rows = rows.withColumn("_p", (1 + F.floor(rest / (3 + F.col("_g") % 8))).cast("int"))
    block = F.slice("_words", F.col("_a") + 1, F.col("_p"))
    again = F.slice(F.flatten(F.array_repeat(block, F.ceil(rest / F.col("_p")).cast("int"))), F.lit(1), rest)
    changed = F.concat_ws(" ", F.slice("_words", F.lit(1), F.col("_a")), again)
    return rows.select("doc_id", F.when(F.col("_n") > 0, changed).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark, sf_dir):
    """Runs of repeated words of every document, some of them made periodic."""
    found = periodic_runs.periodic_runs(planted_periods(documents(spark, sf_dir)))
    best = F.aggregate(
        "runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
        lambda top, run: F.when(top.isNull() | (run["length"] * top["period"] > top["length"] * run["period"]), run).otherwise(top))
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", *(run[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("_best.start").alias("start"), F.col("_best.length").alias("length"), F.col("_best.period").alias("period"),
        F.expr("(1000 * _best.length) div _best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_sentencepiece(spark, sf_dir):
    """Pieces of every document, and the digest of their decoded text."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = piece_codec.encode(documents(spark, sf_dir), model, decoded=True)
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0).cast("long")).alias("n_bytes"))


def op13_ranked_search(spark, sf_dir):
    """The 20 best documents for every benchmark item."""
    return ranked_search.rank_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_mixture_packing": op2_mixture_packing,
    "op3_toxicity": op3_toxicity,
    "op4_language_id": op4_language_id,
    "op5_main_text": op5_main_text,
    "op6_piecewise_fingerprint": op6_piecewise_fingerprint,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_line_runs": op9_line_runs,
    "op10_mix_sources": op10_mix_sources,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_ranked_search": op13_ranked_search,
}
