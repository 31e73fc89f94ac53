"""Spark session helpers.

Library code never builds its own session; it takes the caller's.  The helpers
here are for tests, ``bench.py`` and scripts, plus the one rule every iterative
operator needs: lineage is cut with reliable ``checkpoint()`` into the shared
folder named by ``spark.checkpoint.dir``.  That setting is read from the
session; a private folder is only created when it is unset (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python workers are reused across tasks of a stage.
    "spark.python.worker.reuse": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "linkrec", driver_memory: str = "16g") -> SparkSession:
    """Session for tests / bench.  Cluster jobs pass their own session."""
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in _CONF.items():
        builder = builder.config(k, v)
    builder = (builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.default.parallelism", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Uses ``spark.checkpoint.dir`` when the cluster names one; only when it is
    unset (local tests) a private folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="linkrec-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "linkrec-tables", f"{name}-{uuid.uuid4().hex[:12]}")


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_freed(spark: SparkSession):
    """Spark deletes the shuffle files of a query run in here when it ends, not when the driver collects its garbage."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def materialize(df, name: str = "state", **options: str):
    """Cut lineage by writing ``df`` as parquet under the shared checkpoint
    folder and reading it back.

    Used by the iterative operators: the reread plan is a plain file scan, so
    neither planning time nor recovery replays grow with the round number
    (a checkpointed relation still carries information about its origin plan,
    which the optimizer walks again every round).  The shuffle files of the write are freed.
    ``options`` go to the parquet writer.
    """
    path = scratch_path(df.sparkSession, name)
    with _shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").options(**options).parquet(path)
    written = df.sparkSession.read.parquet(path)
    written._scratch = path
    return written


def discard(df) -> None:
    """Deletes the table that ``materialize`` wrote for this very ``df``; nothing may read it any more."""
    path = df.__dict__.pop("_scratch", None)
    if path is not None:
        at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
