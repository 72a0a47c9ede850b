"""Session settings and the shared scratch area."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(app: str = "martkit", cpus: int | None = None, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    cpus = cpus or os.cpu_count() or 1
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        # the JVM never compiles methods above 8000 bytes; wide cleaning projections exceed that as one method
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting gets
    a temporary folder; on a cluster its absence is an error, since a machine-local folder would lose data.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="martkit-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared root, never used before."""
    return f"{_own_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def _own_root(spark: SparkSession) -> str:
    return f"{shared_root(spark).rstrip('/')}/martkit/{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove what this application has staged in the shared folder, once no result depends on it any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
