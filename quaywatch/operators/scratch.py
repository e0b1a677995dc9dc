"""Folders that the driver and all executors share, for what a run writes on its way."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, one of our own, if driver and executors are one process; else an error."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir isn't set; it must name a folder that the driver and all executors share")
        found = "file://" + os.path.join(tempfile.gettempdir(), "quaywatch-shared")
    return found.rstrip("/")


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which goes when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(there)
    return path
