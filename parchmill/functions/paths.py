"""Folders that driver and executors share, and tables written to cut a plan."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name that driver and executors both see.

    The cluster names the folder in ``spark.checkpoint.dir``.  Where that is
    unset, a local session (one machine) gets a temporary folder, and any other an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.conf.get("parchmill.local.dir", "")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("parchmill.local.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts lineage in a way that survives the loss of executors, and stops
    an expensive plan that is used twice from running twice.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that nothing will read again."""
    for p in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
