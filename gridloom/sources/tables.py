"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One named table of a data folder; Spark's reader opens the path, whatever the store."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
