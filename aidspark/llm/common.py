"""Helpers shared by the training-data operators.

Conventions that every operator of this package follows:

* a document is a row; ``id_col`` names its integer id and ``text_col`` its
  text. Only these two columns are read, so further columns of any name cannot
  clash with internal ones;
* a null text is an empty text;
* a null id sorts after every other id;
* words are the maximal runs of bytes other than the six ASCII white-space
  characters, which is what ``bytes.split()`` returns.
"""

from __future__ import annotations

import math

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aidspark.session import scratch_dir

#: Stands for a null id where ids are ordered.
LAST_ID = (1 << 63) - 1
#: Characters of text that one shuffle bucket is sized for. A bucket is worked
#: on as a whole in one task, so this bounds its memory at every input size.
CHARS_PER_BUCKET = 8_000_000
BATCH_ROWS = 1_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def short_batches(docs: DataFrame) -> DataFrame:
    """Texts go to Python in batches of at most ``BATCH_ROWS`` rows: the default
    of 10,000 texts costs each task a few hundred MB, in the JVM's Arrow buffers
    and again in Python."""
    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key, "10000")) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return docs


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` (never null) of every row, nothing else."""
    return short_batches(docs).select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``documents`` with the row key that work spread over several rows comes
    back to: ``rid`` (the id, ``LAST_ID`` for null) and ``rhash`` (hash of the
    text). Rows that repeat both are equal in all that the operators read."""
    return documents(docs, id_col, text_col).withColumns({
        "rid": F.coalesce(F.col("doc_id"), F.lit(LAST_ID)),
        "rhash": F.xxhash64("text")})


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (all columns, whatever their names) with the key of ``keyed``."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return short_batches(docs).select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                       F.coalesce(docs[id_col].cast("long"), F.lit(LAST_ID)).alias("rid"),
                       F.xxhash64(text).alias("rhash"))


def unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col("row")[c].alias(c) for c in columns])


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def crc_fold(id_: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as ''."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % folds


def bucket_count(docs: DataFrame, text_col: str = "text", per: int = CHARS_PER_BUCKET) -> int:
    """Buckets in proportion to the text, so that each stays bounded."""
    chars = docs.agg(F.sum(F.length(text_col)).alias("n")).first()["n"] or 0
    return max(4, math.ceil(chars / per))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage with
    files that outlive any executor."""
    spark: SparkSession = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class WordHash(dict):
    """word (bytes) -> 64-bit hash, remembered for the words of a task."""

    LIMIT = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads the bits of a 64-bit value."""
    x = (x ^ (x >> np.uint64(30))) * _MIX2
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive elements (order matters)."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    m = len(h) - n + 1
    out = np.zeros(m, np.uint64)
    for i in range(n):
        out = out * _MIX + h[i:i + m]
    return mix(out)
