"""What the operators of this subpackage share: table access and cutting of lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.sources.storage import shared_dir, stored  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One named table of a data folder, through Spark's reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_side(df: DataFrame, most_rows: int) -> DataFrame:
    """A stored df of narrow rows, marked for broadcast if it has at most so many rows; else joins shuffle it."""
    return F.broadcast(df) if df.count() <= most_rows else df


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """From now on Python workers get at most so many rows at once: texts may be long, and either side holds whole batches."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
