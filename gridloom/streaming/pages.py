"""Extraction over a growing folder of page documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gridloom.sources.wikitext import extract_cells


def extract_stream(spark: SparkSession, folder: str, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Each new JSON-lines file of (page_id, wikitext) once, as cells to ``sink`` (batch, its number); ends when all are read."""
    pages = spark.readStream.schema("page_id string, wikitext string").json(folder)
    run = lambda batch, number: sink(extract_cells(batch), number)
    return pages.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
