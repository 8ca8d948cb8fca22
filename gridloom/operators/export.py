"""Ground truth rows and dense tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ENTITY_ROOT = "http://www.wikidata.org/entity/"


def _address(c):
    return F.when(F.coalesce(c, F.lit("")) == "", "UNKNOWN").when(c.startswith("Q"), F.concat(F.lit(ENTITY_ROOT), c)).otherwise(c)


def cea_rows(cells: DataFrame) -> DataFrame:
    """table_id, row, col, answer: body cells of columns that have an entity anywhere."""
    has = cells.groupBy("table_id", "col_id").agg(F.bool_or(F.col("entity") != "").alias("has")).filter("has")
    rows = cells.filter("NOT is_header").join(has.select("table_id", "col_id"), ["table_id", "col_id"], "left_semi")
    return rows.select("table_id", F.col("row_id").alias("row"), F.col("col_id").alias("col"), _address(F.col("entity")).alias("answer"))


def cta_rows(perfect: DataFrame) -> DataFrame:
    """table_id, col, answer."""
    return perfect.select("table_id", F.col("col_id").alias("col"), _address(F.col("perfect")).alias("answer"))


def target_rows(truth: DataFrame) -> DataFrame:
    return truth.drop("answer")


def dense_rows(cells: DataFrame, value: str = "text", body_only: bool = True) -> DataFrame:
    """table_id, row_id, values in order of columns."""
    rows = cells.filter("NOT is_header") if body_only else cells
    entries = F.array_sort(F.collect_list(F.struct("col_id", F.coalesce(value, F.lit("")).alias("v"))))
    return rows.groupBy("table_id", "row_id").agg(F.transform(entries, lambda x: x["v"]).alias("values"))


def table_documents(cells: DataFrame) -> DataFrame:
    """table_id, document: each table as a pretty JSON text."""
    dense = dense_rows(cells, "text", False).join(dense_rows(cells, "link", False).withColumnRenamed("values", "links"), ["table_id", "row_id"])
    rows = dense.groupBy("table_id").agg(F.array_sort(F.collect_list(F.struct("row_id", "values", "links"))).alias("rows"))
    body = F.struct(F.transform("rows", lambda r: r["values"]).alias("text"), F.transform("rows", lambda r: r["links"]).alias("link"))
    return rows.select("table_id", F.to_json(body, {"pretty": "true"}).alias("document"))
