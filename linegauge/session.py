"""Session settings and scratch folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "linegauge", memory: str = "8g") -> SparkSession:
    """Local session for tests and the bench. On a cluster the caller brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # A session that runs many reports needs room for their compiled stages; the default keeps 100.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        # Call sites in error messages cost two JVM calls per column operation while a plan is built.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else str(cpus))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a session of one process (tests, one machine) that names none gets a temporary folder of this machine; elsewhere executors
    would each write to their own disk, so that is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    leaf = f"linegauge-{label}-{uuid.uuid4().hex}"
    if shared:
        return f"{shared.rstrip('/')}/{leaf}"
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{tempfile.mkdtemp(prefix='linegauge-')}/{leaf}"
