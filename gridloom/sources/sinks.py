"""Writers: Parquet inside, JSON and CSV at the boundary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.export import dense_rows, target_rows


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_page_documents(documents: DataFrame, path: str) -> None:
    """One folder for each source file, gzip JSON lines."""
    documents.write.mode("overwrite").partitionBy("source_file").option("compression", "gzip").json(path)


def write_counters(counters: DataFrame, path: str) -> None:
    """A row of counters as JSON."""
    counters.coalesce(1).write.mode("overwrite").json(path)


def write_ordered(df: DataFrame, path: str) -> None:
    """A sorted table as JSON lines that keep the order by file name."""
    df.write.mode("overwrite").json(path)


def write_tables_csv(cells: DataFrame, path: str) -> None:
    """The body of each table as CSV with the header col0, col1, ...: one folder for each table, all widths in one job."""
    rows = dense_rows(cells)
    width = rows.groupBy("table_id").agg(F.max(F.size("values")).alias("width"))
    heads = width.select("table_id", F.lit(-1).alias("row_id"), F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda i: F.concat(F.lit("col"), i.cast("string"))).alias("values"))
    quoted = lambda v: F.when(v.rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(v)
    lines = heads.unionByName(rows).select("table_id", "row_id", F.array_join(F.transform("values", quoted), ",").alias("line"))
    lines.repartition("table_id").sortWithinPartitions("table_id", "row_id").select("table_id", "line").write.mode("overwrite").partitionBy("table_id").text(path)


def write_truth(truth: DataFrame, path: str) -> None:
    """Ground truth without header, and its targets (the answers left out) beside it."""
    truth.write.mode("overwrite").option("header", False).csv(f"{path}/gt")
    target_rows(truth).write.mode("overwrite").option("header", False).csv(f"{path}/target")


def write_relations(majority: DataFrame, path: str) -> None:
    """Ground truth on pairs of columns, without header: table, two columns, predicate."""
    majority.select("table_id", "col_1", "col_2", "predicate").write.mode("overwrite").option("header", False).csv(path)


def write_pairs(pairs: DataFrame, path: str) -> None:
    """A dictionary of two columns as JSON lines: the audit of links and entities, acronyms with their meanings."""
    pairs.write.mode("overwrite").json(path)
