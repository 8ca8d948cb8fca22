"""Rules on columns, rows and tables of the cell model. Each rule is an aggregate by key; removal is an anti join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions import text as T

_SENTINELS = ("IMAGE", "HELP_PAGE", "WIKI_PROJ_PAGE")


def _body():
    return ~F.col("is_header")


def column_links(cells: DataFrame, value: str = "link") -> DataFrame:
    """table_id, col_id, n_links: cells with a value."""
    return cells.groupBy("table_id", "col_id").agg(F.count_if(F.coalesce(F.col(value), F.lit("")) != "").alias("n_links"))


def link_gate(cells: DataFrame, least: int = 3, value: str = "link", body_only: bool = False) -> DataFrame:
    """Tables of which some column has enough links: table_id, n_rows, n_cols, max_links. One aggregate over columns, one over tables.

    Both aggregates go by table, so the second needs no shuffle of its own.
    """
    counted = F.coalesce(F.col(value), F.lit("")) != ""
    if body_only:
        counted = counted & _body()
    columns = cells.groupBy("table_id", "col_id").agg(F.count_if(counted).alias("n"), F.max("row_id").alias("last"))
    tables = columns.groupBy("table_id").agg((F.max("last") + 1).cast("long").alias("n_rows"), F.count(F.lit(1)).alias("n_cols"), F.max("n").alias("max_links"))
    return tables.filter(F.col("max_links") >= least)


def target_columns(cells: DataFrame) -> DataFrame:
    """All columns tied at the most links of their table."""
    n = column_links(cells)
    return n.withColumn("most", F.max("n_links").over(Window.partitionBy("table_id"))).filter("n_links = most AND most > 0").drop("most")


def sentinel_columns(cells: DataFrame) -> DataFrame:
    return cells.groupBy("table_id", "col_id").agg(F.bool_or(F.col("text").isin(*_SENTINELS)).alias("hit")).filter("hit").drop("hit")


def empty_body_columns(cells: DataFrame) -> DataFrame:
    return cells.groupBy("table_id", "col_id").agg(F.count_if(_body()).alias("n")).filter("n = 0").drop("n")


def _column_rule(cells: DataFrame, test) -> DataFrame:
    return cells.filter(_body()).groupBy("table_id", "col_id").agg(test.alias("hit")).filter("hit").drop("hit")


def sparse_columns(cells: DataFrame) -> DataFrame:
    """Half or more of the body is empty."""
    return _column_rule(cells, F.count_if(T.is_blank(F.col("text"))) * 2 >= F.count(F.lit(1)))


def constant_columns(cells: DataFrame) -> DataFrame:
    """One value in the whole body: its smallest is its largest."""
    value = F.coalesce(F.col("text"), F.lit(""))
    return _column_rule(cells, F.min(value) == F.max(value))


def id_columns(cells: DataFrame) -> DataFrame:
    return _column_rule(cells, F.bool_and(F.coalesce(F.col("text"), F.lit("")).rlike("^Q[0-9]+$")))


def removed_columns(cells: DataFrame) -> DataFrame:
    """Columns that any rule removes, in one pass."""
    text = F.coalesce(F.col("text"), F.lit(""))
    body = F.count_if(_body())
    rules = cells.groupBy("table_id", "col_id").agg(
        (
            F.bool_or(text.isin(*_SENTINELS))
            | (body == 0)
            | (F.count_if(_body() & T.is_blank(text)) * 2 >= body)
            | (F.min(F.when(_body(), text)) == F.max(F.when(_body(), text)))
            | F.coalesce(F.bool_and(F.when(_body(), text.rlike("^Q[0-9]+$"))), F.lit(True))
        ).alias("hit")
    )
    return rules.filter("hit").drop("hit")


def without_repeated_first_word(cells: DataFrame) -> DataFrame:
    """The optional rule on a first word that a whole column's body shares: it is cut off."""
    first = F.split_part(F.col("text"), F.lit(" "), F.lit(1))
    shared = cells.filter(_body()).groupBy("table_id", "col_id").agg(F.min(first).alias("word"), F.max(first).alias("last"), F.bool_and(F.contains("text", F.lit(" "))).alias("longer"))
    shared = shared.filter("word = last AND longer AND word <> ''").drop("last", "longer")
    out = cells.join(shared, ["table_id", "col_id"], "left")
    cut = F.when(_body() & F.col("word").isNotNull(), F.substring(F.col("text"), F.length("word") + 2, F.length("text"))).otherwise(F.col("text"))
    return out.withColumn("text", cut).drop("word")


def _row_rule(cells: DataFrame, test) -> DataFrame:
    return cells.groupBy("table_id", "row_id").agg(test.alias("hit")).filter("hit").drop("hit")


def sparse_rows(cells: DataFrame) -> DataFrame:
    return _row_rule(cells, F.count_if(T.is_blank(F.col("text"))) * 2 >= F.count(F.lit(1)))


def constant_rows(cells: DataFrame) -> DataFrame:
    value = F.coalesce(F.col("text"), F.lit(""))
    return _row_rule(cells, F.min(value) == F.max(value))


def total_rows(cells: DataFrame) -> DataFrame:
    return _row_rule(cells, F.count_if(F.contains(F.lower("text"), F.lit("total"))) >= 2)


def none_rows(cells: DataFrame) -> DataFrame:
    return _row_rule(cells, F.bool_and(F.contains(F.lower(F.coalesce("text", F.lit(""))), F.lit("none"))))


def removed_rows(cells: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    low = F.lower(text)
    return _row_rule(
        cells,
        (F.count_if(T.is_blank(text)) * 2 >= F.count(F.lit(1)))
        | (F.min(text) == F.max(text))
        | (F.count_if(F.contains(low, F.lit("total"))) >= 2)
        | F.bool_and(F.contains(low, F.lit("none"))),
    )


def reindexed(cells: DataFrame, removed: DataFrame, key: str) -> DataFrame:
    """cells without the removed columns or rows (key: col_id or row_id); the rest numbered from 0, the old number as orig_<key>."""
    kept = cells.join(removed, ["table_id", key], "left_anti")
    ids = kept.select("table_id", key).distinct()
    ids = ids.withColumn("new", F.row_number().over(Window.partitionBy("table_id").orderBy(key)) - 1)
    return kept.join(ids, ["table_id", key]).withColumnRenamed(key, f"orig_{key}").withColumnRenamed("new", key)


def filtered(cells: DataFrame, least: int = 3) -> DataFrame:
    """All rules in order: columns, rows, links into sections, then the gate on tables."""
    out = reindexed(cells, removed_columns(cells), "col_id")
    out = reindexed(out, removed_rows(out), "row_id").withColumn("link", T.clean_link(F.col("link")))
    return out.join(link_gate(out, least).select("table_id"), "table_id", "left_semi")


def rows_with_ids(cells: DataFrame) -> DataFrame:
    """Rows in which a direct entity link shows its id as text."""
    return cells.filter(F.col("link").startswith(":d:Q") & F.col("text").rlike("Q[0-9]+")).select("table_id", "row_id").distinct()


def misshapen(cells: DataFrame) -> DataFrame:
    """Tables with missing cells: fewer than rows times columns."""
    size = (F.max("row_id") + 1) * (F.max("col_id") + 1)
    return cells.groupBy("table_id").agg(size.alias("expected"), F.count(F.lit(1)).alias("found")).filter("expected <> found")


def export_ready(cells: DataFrame, least: int = 3) -> DataFrame:
    """Cells for the export: without rows that show an id, without misshapen tables, of tables with enough entities in a body column."""
    out = reindexed(cells, rows_with_ids(cells), "row_id")
    out = out.join(misshapen(out).select("table_id"), "table_id", "left_anti")
    return out.join(link_gate(out, least, "entity", True).select("table_id"), "table_id", "left_semi")
