"""Manifests kept up by file (D1, D2): only files that changed are read.

The state holds, for every file of a year table, its path, size and time and
its row count per year and month. A refresh lists the files (metadata only),
reads those that the state does not know as they are, drops those that are
gone, and writes the new state beside the old one; the manifest is an aggregate
of the state. A run over unchanged files reads no data.

A state is a numbered folder, complete once it has its success mark, so a
refresh that dies leaves the one before in force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aidspark.operators.catalog import SOURCE_COVERAGE, manifest_of_counts
from aidspark.plans.storage import path_exists

_STATE = "path string, byte bigint, tempo timestamp, anno int, mese int, righe bigint"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    if not path_exists(spark, root):
        return []
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    names = [s.getPath().getName() for s in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]
    return sorted(int(n[5:]) for n in names if n.startswith("state") and path_exists(spark, f"{root}/{n}/_SUCCESS"))


def state(spark: SparkSession, root: str) -> DataFrame:
    """The newest complete state under ``root``; empty if there is none."""
    known = _numbers(spark, root)
    return spark.read.schema(_STATE).parquet(f"{root}/state{known[-1]}") if known else spark.createDataFrame([], _STATE)


def files(spark: SparkSession, layer: str) -> DataFrame:
    """``path, byte, tempo`` of the layer's files, from its listing."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(layer)
            .select("path", F.col("length").alias("byte"), F.col("modificationTime").alias("tempo")))


def refresh(spark: SparkSession, layer: str, root: str) -> list[str]:
    """Bring the state under ``root`` up to the files of ``layer`` (a Parquet
    dataset partitioned by ``anno``). Returns the files that were read."""
    old, now = state(spark, root), files(spark, layer)
    key = ["path", "byte", "tempo"]
    # file names of one refresh: what changed since the last one
    changed = [r["path"] for r in now.join(old.select(*key).distinct(), key, "left_anti").select("path").collect()]
    kept = old.join(now, key, "left_semi")
    if not changed and kept.count() == old.count():
        return []
    new = kept
    if changed:
        counted = (spark.read.option("basePath", layer).parquet(*changed)
                   .select(F.col("_metadata.file_path").alias("path"), "anno", "mese")
                   .groupBy("path", "anno", "mese").agg(F.count(F.lit(1)).alias("righe")))
        # a file without rows stays known
        new = kept.unionByName(now.where(F.col("path").isin(changed)).join(counted, "path", "left").select(*[
            F.col(c.split()[0]).cast(c.split()[1]) for c in _STATE.split(", ")]))
    number = (_numbers(spark, root) or [0])[-1] + 1
    new.hint("rebalance").write.mode("overwrite").parquet(f"{root}/state{number}")  # a row a file and month
    return sorted(changed)


def manifest(spark: SparkSession, root: str, coverage=SOURCE_COVERAGE) -> DataFrame:
    """D1 from the state: as ``manifest_by_year`` of the layer."""
    return manifest_of_counts(state(spark, root).where(F.col("anno").isNotNull()), coverage)
