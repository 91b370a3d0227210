"""The corpus pipeline: five stages over ``documents``, each written as Parquet
and reread as the next one's input. All but the last return the columns of
``documents``; the last returns the pieces of the packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aidspark.llm import bm25, packing, setsketch, toxicity, winnow
from aidspark.llm.common import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from the labelled ones, does
    not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return docs.filter(~toxicity.rejected(docs, toxicity.fit(docs, labels, "toxic")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines, and then without the passages of 50
    words and more, that an earlier place has; ``n_chars`` follows the text. A
    document of which no line or no word is left goes."""
    done = winnow.dedup_lines(docs)
    left = (F.col("line_dedup.n_removed") == 0) | (F.col("line_dedup.n_removed") < F.col("line_dedup.n_lines"))
    lines = materialize(done.filter(left).select(*docs.columns), "deduped-lines")
    done = winnow.dedup_passages(lines)
    left = (F.col("passage_dedup.n_removed") == 0) | (F.col("passage_dedup.n_removed") < F.col("passage_dedup.n_words"))
    out = done.filter(left).select(*docs.columns)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.length(F.coalesce("text", F.lit("")))
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), changed).cast(kind))
    return out


def first_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates (5-word shingles,
    similarity of 0.8 and over)."""
    return setsketch.first_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return bm25.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 ids."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("line dedup", dedup_lines), ("near dedup", first_of_near_duplicates),
          ("decontamination", decontaminate), ("packing", pack)]

#: Model scores and tokens cannot be written in SQL; ``tests/llm`` holds the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
