"""Counters of a corpus: one aggregate each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.filters import link_gate


def table_shapes(cells: DataFrame) -> DataFrame:
    return cells.groupBy("table_id").agg((F.max("row_id") + 1).cast("long").alias("n_rows"), (F.max("col_id") + 1).cast("long").alias("n_cols"))


def corpus_stats(cells: DataFrame, classes: DataFrame) -> DataFrame:
    """One row: numbers of tables, rows, columns, cells, nils, mentions, entities and kinds of columns."""
    per_table = cells.groupBy("table_id").agg(
        (F.max("row_id") + 1).cast("long").alias("r"),
        (F.max("col_id") + 1).cast("long").alias("c"),
        F.count_if(F.col("entity") == "NIL").alias("nils"),
        F.count_if(F.col("entity") != "").alias("mentions"),
    )
    shape = per_table.agg(
        F.count(F.lit(1)).alias("n_tables"),
        *[f(x).alias(f"{n}_{w}") for f, n in ((F.sum, "sum"), (F.max, "max"), (F.min, "min")) for x, w in (("r", "rows"), ("c", "cols"))],
        F.sum(F.col("r") * F.col("c")).alias("cells"),
        F.sum("nils").alias("nils"),
        F.sum("mentions").alias("mentions"),
    )
    entities = cells.filter(F.col("entity").startswith("Q")).agg(F.count_distinct("entity").alias("all_entities"))
    kinds = classes.agg(F.count_if(F.col("col_type") == "LIT").alias("lit_cols"), F.count_if(F.col("col_type") == "NE").alias("ne_cols"))
    return shape.join(entities).join(kinds)  # one row each


_SUMMED = "tot_linked_cell nils types_not_found types_found count_with_header count_with_caption generic_types specific_types filtered_types found_perfect_types tot_cols_with_types count_single_domain count_multi_domain".split()
_CHANGED = "acro_added typos_added approx_added alias_added cols_with_acronyms cols_with_typos cols_with_approx cols_with_aliases".split()


def export_counters(cells: DataFrame, table_stats: DataFrame, classes: DataFrame, changes: DataFrame, least: int = 3) -> DataFrame:
    """One row: 33 counters of the tables that have enough entities in a body column. changes: counts of each kind by table."""
    gate = link_gate(cells, least, "entity", True).select("table_id")
    kept = cells.join(gate, "table_id", "left_semi")
    shapes = kept.groupBy("table_id").agg((F.max("row_id") + 1).cast("long").alias("r"), (F.max("col_id") + 1).cast("long").alias("c"), F.count_if(F.col("entity") != "").alias("mentions"))
    kinds = classes.groupBy("table_id").agg(F.count_if(F.col("col_type") == "LIT").alias("lit_cols"), F.count_if(F.col("col_type") == "NE").alias("ne_cols"))
    all_ = shapes.join(table_stats.select("table_id", *_SUMMED), "table_id").join(kinds, "table_id", "left").join(changes.select("table_id", *_CHANGED), "table_id", "left").fillna(0)
    counts = all_.agg(
        F.count(F.lit(1)).alias("n_tables"),
        *[f(x).alias(f"{n}_{w}") for f, n in ((F.max, "max"), (F.min, "min")) for x, w in (("r", "rows"), ("c", "cols"))],
        F.sum(F.col("r") * F.col("c")).alias("cells"),
        F.sum("r").alias("rows"),
        F.sum("c").alias("cols"),
        *[F.sum(x).alias(x) for x in ("mentions", "lit_cols", "ne_cols", *_SUMMED, *_CHANGED)],
    )
    entities = kept.filter(F.col("entity").startswith("Q")).agg(F.count_distinct("entity").alias("all_entities"))
    return counts.join(entities)  # one row each


def extract_counters(pages: DataFrame, raw: DataFrame, cells: DataFrame) -> DataFrame:
    """One row: pages read, tables met, those with a link, and what is kept. raw: cells of all tables; cells: of those that pass."""
    tables = raw.groupBy("table_id").agg(F.bool_or(F.size("targets") > 0).alias("linked"))
    met = tables.agg(F.count(F.lit(1)).alias("tot_tab"), F.count_if("linked").alias("tot_linked_tab"))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    kept = table_shapes(cells).agg(F.count(F.lit(1)).alias("keep_tab"), zero("n_rows").alias("keep_rows"), zero("n_cols").alias("keep_cols"))
    return pages.agg(F.count(F.lit(1)).alias("tot_pages")).join(met).join(kept)  # one row each


def filter_counters(before: DataFrame, after: DataFrame) -> DataFrame:
    n = F.count_distinct("table_id")
    return before.agg(n.alias("tables")).join(after.agg(n.alias("kept")))  # one row each


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that stand more than once, with their number."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
