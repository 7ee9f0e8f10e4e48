"""Session settings and lineage cutting.

Jobs in this package cut long lineages by writing an intermediate result
to the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``
and reading it back.  The folder is read from the session; only a local
session with no folder configured (unit tests) gets a private one.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings a caller may apply when it owns the session (bench, tests).  The
# library itself never depends on them for correctness.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a vehicle list beyond the broadcast budget still filters samples, by a Bloom filter made of it
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "fleetframe", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None for a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def _is_local(spark: SparkSession) -> bool:
    ctx = _context(spark)
    master = ctx.master if ctx is not None else spark.conf.get("spark.master", "")
    return master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate results.

    Order: ``spark.checkpoint.dir`` from the session conf, then the folder
    already set on the SparkContext.  A local session without either gets a
    fresh private folder; a cluster session without either is an error,
    because a machine-local folder would not survive the loss of an executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    ctx = _context(spark)
    if not root and ctx is not None:
        root = ctx.getCheckpointDir()
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(e.g. an object-store or HDFS path) before running fleetframe jobs")
        root = tempfile.mkdtemp(prefix="fleetframe-ckpt-")
        if ctx is not None:
            ctx.setCheckpointDir(root)
    return root.rstrip("/")


# Folder of the pipeline run active in this thread/context (set by plans.pipeline);
# other threads sharing the session keep writing to the common folder.
_RUN_DIR: ContextVar[str | None] = ContextVar("fleetframe_run_dir", default=None)


@contextmanager
def run_folder(path: str):
    """Put this context's intermediates under ``path`` while the block runs."""
    token = _RUN_DIR.set(path)
    try:
        yield path
    finally:
        _RUN_DIR.reset(token)


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new, unique folder under the checkpoint root (under the current
    pipeline run's folder while one is active in this context)."""
    base = _RUN_DIR.get() or f"{checkpoint_root(spark)}/fleetframe"
    return f"{base}/{tag}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor recomputes from the written files, not
    from the raw input), fixes values that depend on physical layout (range
    partition ids, row ids), and gives the optimizer exact file sizes for
    later join planning.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python code can use the path."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
