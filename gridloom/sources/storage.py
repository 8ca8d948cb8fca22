"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset in a local session, a folder of our own. On a cluster it has to be set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="gridloom-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def stored(df: DataFrame) -> DataFrame:
    """Write df once into the shared folder and read it back: cuts lineage and survives lost executors.

    One pass, where an eager checkpoint() would run the last stage twice.
    """
    path = scratch(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
