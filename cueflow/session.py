"""Session settings every operator relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def session(master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``master`` and ``conf`` are for tests and benches.

    On a cluster the resource settings come from spark-submit, so nothing here sizes memory or partitions.
    """
    builder = (
        SparkSession.builder.appName("cueflow")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch(spark: SparkSession, name: str) -> str:
    """A path that all executors share, below ``spark.checkpoint.dir``; what is written there goes when the application ends.

    In local mode, as in tests, a temporary folder becomes the setting where it is unset.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="cueflow-")
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path
