"""One type for each column: coverage, threshold, perfect type, domain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.config import DEFAULT, Config


def coverage(cells: DataFrame) -> DataFrame:
    """cells with types -> table_id, col_id, type, n, n_rows, coverage: share of the table's rows, header rows included."""
    rows = cells.groupBy("table_id").agg((F.max("row_id") + 1).cast("long").alias("n_rows"))
    counts = cells.select("table_id", "col_id", F.explode("types").alias("type")).groupBy("table_id", "col_id", "type").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(rows, "table_id").withColumn("coverage", F.col("n") / F.col("n_rows"))


def split_known(covered: DataFrame, depth: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(types that are classes with a superclass, with depth and n_ancestors; the distinct others)."""
    keyed = covered.withColumn("cls", F.substring(F.col("type"), F.lit(2), F.length("type")).try_cast("bigint"))
    return keyed.join(depth, "cls"), split_unknown(covered, depth).select("type").distinct()


def split_unknown(covered: DataFrame, depth: DataFrame) -> DataFrame:
    """The coverage of types that aren't classes with a superclass."""
    keyed = covered.withColumn("cls", F.substring(F.col("type"), F.lit(2), F.length("type")).try_cast("bigint"))
    return keyed.join(depth.select("cls"), "cls", "left_anti").drop("cls")


def threshold(n_rows, config: Config = DEFAULT):
    """Falls with the number of rows; null for two rows, where it isn't defined."""
    base = F.lit(config.coverage_base)
    return base + F.try_divide(F.lit(1.0) - base, (n_rows - 2).cast("double"))


def perfect_types(known: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """table_id, col_id, perfect: the most specific type that covers enough rows, '' if none."""
    enough = F.col("coverage") >= threshold(F.col("n_rows"), config)
    best = F.max_by(F.when(enough, F.col("type")), F.when(enough, F.struct("n_ancestors", "depth", "cls")))
    return known.groupBy("table_id", "col_id").agg(F.coalesce(best, F.lit("")).alias("perfect"))


def column_types(known: DataFrame) -> DataFrame:
    """table_id, col_id, types from generic to specific with their coverage."""
    entries = F.array_sort(F.collect_list(F.struct("n_ancestors", "depth", "cls", "type", "coverage")))
    return known.groupBy("table_id", "col_id").agg(F.transform(entries, lambda x: F.struct(x["type"].alias("qid"), x["coverage"].alias("coverage"))).alias("col_types"))


def domains(perfect: DataFrame) -> DataFrame:
    """table_id, n_perfect, single_domain: at most two columns with a perfect type."""
    n = F.count_if(F.col("perfect") != "")
    return perfect.groupBy("table_id").agg(n.alias("n_perfect"), (n <= 2).alias("single_domain"))
