"""A corpus pipeline of five stages over documents, each one of the library's operators.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, is written as
Parquet into the folder the cluster shares, and is read again as the next one's
docs. All but the last return the columns of documents.

A null text stays null up to the last stage, where it counts as empty, and with
empty texts makes one group of copies; a null source is a source of its own; a
null doc_id is kept like any other. Of repeated rows one stays. Very long texts
are read whole. Empty tables give an empty result. Further columns, whatever
their names, go through all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import lines, mixing, near_dup, segment, toxicity
from gridloom.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go. The labels' held-out rows are never learned from."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates are cut out of the texts; n_chars follows the text."""
    out = lines.cut_rows(docs, by_group=True)
    made = {"text": F.col("text"), "n_chars": F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("row.n_chars"))}
    return out.select(*[made[c].alias(c) if c in made else F.col(f"row.`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return near_dup.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of each document of the mix."""
    return segment.encode(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_recurring_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: SQL expresses neither nearest neighbours by block, nor signatures, nor sampled segmentations; the tests hold run() against plain versions of each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents of a data folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
