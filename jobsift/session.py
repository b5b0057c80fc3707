"""Session construction and the shared scratch location.

Library code never sets session configuration: it runs inside whatever
session the caller (a cluster job, the test suite, ``bench.py``) built.
``build_session`` is the convenience used by tests and the benchmark.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "jobsift") -> SparkSession:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and p != root]
    os.environ["PYTHONPATH"] = os.pathsep.join([root, *paths])  # for the Python workers
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus) * 2
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it, to shared storage; where it is
    unset there, this raises: executors would write to their own disks. Only
    a local master, whose executors share the driver's disk, gets a temporary
    folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no driver-side context (e.g. Spark Connect)
        sc = None
    root = sc.getCheckpointDir() if sc is not None else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root and sc is not None:
            sc.setCheckpointDir(root)
    if not root:
        if sc is None or not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="jobsift-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


_HANDED_OUT: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder. Whoever has
    consumed what was written there drops it with ``clear_scratch``."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    _HANDED_OUT.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete every scratch path handed out so far: queries that still read
    one must be done."""
    while _HANDED_OUT:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_HANDED_OUT.pop())
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
