"""Session set-up and the shared scratch location.

Runtime settings only; cluster sizing (executors, memory) belongs to the
submitter. ``prepare`` is idempotent and safe to call on a caller's session.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins (broadcast only when the
# runtime size is under the threshold), coalesces small shuffle partitions and
# splits skewed ones.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # A task that writes a table by year keeps a file open for each, instead of
    # sorting its rows by year first; tasks of more years than this still sort.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # The JVM never compiles methods of more than 8,000 bytes, which the fused code
    # of wide projections is: such stages run operator by operator instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(master: str | None = None, app: str = "aidspark",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session. ``master`` is only for local runs and tests."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(RUNTIME_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


@contextmanager
def several_files_at_once(spark: SparkSession, files: int):
    """How many files a task of a partitioned write inside the block keeps open (0:
    one after the other, for rows that are sorted); the session's own setting after it."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(files))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from the session (``spark.checkpoint.dir``, a static setting, or the
    context's checkpoint dir). Only in a local run (one machine, one process)
    where neither is set, a private folder is made and registered with
    ``setCheckpointDir``, so later ``checkpoint()`` calls and scratch paths
    share it. On a cluster a machine's own folder would scatter the files, so
    that raises."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="aidspark-ckpt-"))
        root = spark.sparkContext.getCheckpointDir()
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint root (any Hadoop
    path). Nothing is created here: Spark's writers create their output."""
    root = _checkpoint_root(spark).rstrip("/")
    return f"{root}/aidspark/{name}-{uuid.uuid4().hex[:12]}"
