"""Predicates between column pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_pairs(cells: DataFrame) -> DataFrame:
    """Pairs of entities in one row, left column first: table_id, row_id, col_1, col_2, e1, e2.

    A row's entities are gathered once (a table has at most Config.max_columns of
    them) and paired inside the row, so nothing is joined.
    """
    rows = cells.filter("entity LIKE 'Q%'").groupBy("table_id", "row_id").agg(F.array_sort(F.collect_list(F.struct("col_id", "entity"))).alias("es"))
    pairs = F.flatten(F.transform("es", lambda a: F.transform(F.filter("es", lambda b: b["col_id"] > a["col_id"]), lambda b: F.struct(a["col_id"].alias("col_1"), b["col_id"].alias("col_2"), a["entity"].alias("e1"), b["entity"].alias("e2")))))
    return rows.select("table_id", "row_id", F.explode(pairs).alias("p")).select("table_id", "row_id", "p.*")


def majority_predicates(pairs: DataFrame, kg_predicate: DataFrame) -> DataFrame:
    """table_id, col_1, col_2, predicate: the one most rows have; ties to the one met first, then to the smaller."""
    wanted = pairs.select("e1", "e2").distinct().join(kg_predicate, ["e1", "e2"])
    votes = pairs.join(wanted, ["e1", "e2"]).select("table_id", "row_id", "col_1", "col_2", F.explode("predicates").alias("predicate"))
    counted = votes.groupBy("table_id", "col_1", "col_2", "predicate").agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("first"))
    best = F.min(F.struct((-F.col("n")).alias("n"), "first", "predicate"))
    return counted.groupBy("table_id", "col_1", "col_2").agg(best.alias("best")).select("table_id", "col_1", "col_2", F.col("best.predicate").alias("predicate"), (-F.col("best.n")).alias("votes"))
