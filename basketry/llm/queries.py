"""Catalogue queries of the training-data operators, one per operator, each
over its whole table, with DuckDB SQL where SQL can express the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import (chat, exactdup, importance, language, matrices, mixing, packing, passages, periodic, quality,
                          simhash, topk, vectorgraph)
from basketry.llm.common import read_docs
from basketry.session import cut_lineage


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source weights 3, 1, 2 in turn, 150% of all words."""
    docs = read_docs(spark, sf_dir).select("doc_id", "source", mixing.word_count().alias("size"))
    mixed = mixing.mix_sources(docs, size=F.col("size"))
    return mixed.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                        F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken"),
                        F.col("mix_copies").alias("copies"))


def op2_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents: 3-word shingles, 2 bits."""
    found = simhash.near_duplicates(read_docs(spark, sf_dir), words=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op3_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by a factorisation machine; learnt from labels
    of rows whose crc32 of the id modulo 4 is not 2 (a null id is held out)."""
    docs = read_docs(spark, sf_dir)
    held_out = F.coalesce(language.fold("doc_id", 4) == 2, F.lit(True))
    learn = docs.where(~held_out)
    machine = quality.fit(learn, read_docs(spark, sf_dir, "labels").where(~held_out))
    scored = quality.score(docs.select("doc_id", held_out.alias("held_out"), "text", "n_chars"), machine)
    return scored.select("doc_id", "held_out", F.col("quality_score").alias("score"),
                         (F.col("quality_score") >= 0.7).cast("int").alias("predicted"))


def op4_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate embeddings: cosine of at least 0.95."""
    found = vectorgraph.near_duplicates(read_docs(spark, sf_dir, "embeddings"), threshold=0.95)
    return found.withColumnRenamed("component", "component_id")


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products of every embedding whose id 50 divides, against
    all others."""
    return topk.top_k(read_docs(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of at least 50 words that an earlier document has, 80% equal."""
    return passages.repeated_passages(read_docs(spark, sf_dir), min_words=50, min_identity=0.8)


def op7_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return packing.pack_documents(read_docs(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op8_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maximal logged conversations, rendered."""
    return chat.chat_format(read_docs(spark, sf_dir, "conversations"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by compression; learnt from the rows whose
    crc32 of the id modulo 5 is not 0 (a null id is held out)."""
    docs = read_docs(spark, sf_dir)
    held_out = F.coalesce(language.fold("doc_id", 5) == 0, F.lit(True))
    contents = language.fit_dictionaries(docs.where(~held_out))
    found = language.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), contents)
    return found.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"),
                        F.col("lang_margin").alias("margin"), F.col("lang_rejected").alias("rejected"))


def op10_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed token-id matrices, written and read back: one row
    per segment."""
    made = matrices.token_matrices(read_docs(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                   public_tokenizers.PATTERN)
    return matrices.segment_rows(cut_lineage(made, "token-matrices"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of equal text but for white space: the longest of each group stays."""
    found = exactdup.exact_duplicates(spark, f"{sf_dir}/documents.parquet")
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of periodically repeated words in all documents, a tenth of which get
    planted ones first."""
    docs = read_docs(spark, sf_dir).select("doc_id", periodic.plant_runs("doc_id", "text").alias("text"))
    found = periodic.periodic_runs(docs)
    # a greater length / period first, compared exactly; the runs come by start, then period
    more = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    first = F.get("runs", F.lit(0))
    best = F.aggregate("runs", first, lambda a, b: F.when(more(b, a), b).otherwise(a))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    exponent = F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long")
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period", exponent.alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5% of the documents drawn towards the benchmark's texts, all documents weighed."""
    found = importance.resample(read_docs(spark, sf_dir), read_docs(spark, sf_dir, "benchmark"), percent=5)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {"op1_mix_sources": op1_mix_sources, "op2_simhash_neardup": op2_simhash_neardup,
           "op3_quality_fm": op3_quality_fm, "op4_embedding_neardup": op4_embedding_neardup, "op5_exact_topk": op5_exact_topk,
           "op6_substring_dedup": op6_substring_dedup, "op7_bestfit_packing": op7_bestfit_packing,
           "op8_chat_snapshots": op8_chat_snapshots, "op9_language_id": op9_language_id,
           "op10_token_matrices": op10_token_matrices, "op11_exact_dedup": op11_exact_dedup,
           "op12_periodic_runs": op12_periodic_runs, "op13_importance_resampling": op13_importance_resampling}
ORACLES: dict[str, str] = {"op5_exact_topk": topk.ORACLE, "op8_chat_snapshots": chat.ORACLE,
                           "op11_exact_dedup": exactdup.ORACLE}
