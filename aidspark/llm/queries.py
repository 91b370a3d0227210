"""The registered queries of the training-data operators: each applies its
operator, with production parameters, to its whole table and derives the
result columns from the operator's own output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aidspark.llm import (bm25, divergence, fim, hpylm, licenses, packing, qda, rlz, setsketch, sharding, toxicity, turns,
                          winnow)
from aidspark.llm.common import crc_fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_hpylm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model score of every document, learned outside fold 1 of 5."""
    fold = crc_fold(F.col("doc_id"), 5)
    scored = hpylm.score(_table(spark, sf_dir, "documents"), train=fold != 1)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score", "perplexity")


def op2_rlz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What substring deduplication keeps of every document."""
    return rlz.remove_duplicates(_table(spark, sf_dir, "documents")).drop("kept_text")


def op3_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned outside fold 0 of 5."""
    fold = crc_fold(F.col("doc_id"), 5)
    scored = qda.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), "quality",
                          train=fold != 0)
    return scored.select("doc_id", (fold == 0).alias("held_out"), "score", "predicted")


def op4_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, divergences and verdict of every document."""
    return divergence.judge(_table(spark, sf_dir, "documents"))


def op5_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents (3-word shingles, 0.85)."""
    found = setsketch.near_duplicates(_table(spark, sf_dir, "documents"), size=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id",
                        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrase places and license labels of every document."""
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    join = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        join(F.col("base_labels")).alias("base_labels"),
        join(F.concat("base_labels", "method_labels")).alias("labels"), "score")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned outside fold 2 of 4."""
    fold = crc_fold(F.col("doc_id"), 4)
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), "toxic", train=fold != 2)
    return toxicity.score(docs, model).select("doc_id", (fold == 2).alias("held_out"), "score", "predicted")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of the packed documents with a checksum of their ids."""
    pieces = packing.pack(_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset", "sequence_length", "padded_length")


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line deduplication keeps of every document."""
    done = winnow.dedup_lines(_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "line_dedup.n_lines", "line_dedup.n_removed",
                       F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op10_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that training documents hold."""
    return bm25.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("rid", "rhash")


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-the-middle form of every document, and the text rebuilt from it."""
    made = fim.fill_in_middle(_table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
                       digest(fim.restore(F.col("output"), F.col("form"))).alias("restored_sha256"))


def op12_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, damaged before."""
    return turns.repair_damaged(_table(spark, sf_dir, "conversations"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; equal texts are kept together."""
    placed = sharding.shard(_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_hpylm, op2_rlz, op3_qda, op4_divergence, op5_setsketch, op6_licenses, op7_toxicity, op8_packing,
                                   op9_winnowing, op10_bm25, op11_fim, op12_turns, op13_sharding)}


def oracle_sql() -> dict[str, str]:
    return {"op9_winnowing": winnow.ORACLE_SQL, "op11_fim": fim.ORACLE_SQL}
