"""Grids in the cell model made from the driver's tables, in Spark and in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.sources.tables import table


def _cells(rows: DataFrame, columns: list[tuple[Column, Column]]) -> DataFrame:
    """One row a grid row -> one row a cell: the columns (text, link) unpivoted by one explode."""
    parts = [F.struct(F.lit(i).alias("col_id"), t.cast("string").alias("text"), k.cast("string").alias("link")) for i, (t, k) in enumerate(columns)]
    return rows.select("table_id", "row_id", F.lit(False).alias("is_header"), F.explode(F.array(*parts)).alias("c")).select("table_id", "row_id", "is_header", "c.*")


def _numbered(df: DataFrame, table_id: str, by: str) -> DataFrame:
    return df.withColumn("table_id", F.col(table_id)).withColumn("row_id", (F.row_number().over(Window.partitionBy(table_id).orderBy(by)) - 1).cast("int"))


def part_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table for each brand: name (some linked), type (linked), size, brand, a sparse name, an id."""
    p, none = _numbered(table(spark, sf_dir, "part"), "p_brand", "p_partkey"), F.lit("")
    name, kind = F.col("p_name"), F.col("p_type")
    return _cells(
        p,
        [
            (name, F.when(F.col("p_size") % 3 == 0, F.replace(name, F.lit(" "), F.lit("_"))).otherwise(none)),
            (kind, kind),
            (F.col("p_size"), none),
            (F.col("p_brand"), none),
            (F.when(F.col("p_partkey") % 3 == 0, name).otherwise(none), none),
            (F.concat(F.lit("Q"), F.col("p_partkey").cast("string")), none),
        ],
    )


def row_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table for each brand whose rows meet the rules on rows."""
    p, none, k = _numbered(table(spark, sf_dir, "part"), "p_brand", "p_partkey"), F.lit(""), F.col("p_partkey")
    return _cells(
        p,
        [
            (F.when(k % 11 == 0, "Grand Total").when(k % 13 == 0, "None").otherwise(F.col("p_name")), none),
            (F.when(k % 22 == 0, "TOTAL").when(k % 13 == 0, "none").when(k % 7 == 0, F.col("p_name")).when(k % 5 == 0, "-").otherwise(F.col("p_type")), none),
            (F.when(k % 13 == 0, "None").when(k % 7 == 0, F.col("p_name")).when(k % 5 == 0, none).otherwise(F.col("p_size").cast("string")), none),
            (F.when((k % 17 == 0) | (k % 7 == 0), F.col("p_name")).when(k % 13 == 0, "NONE").otherwise(F.col("p_brand")), none),
        ],
    )


def nation_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table for each market segment: customer, nation (linked), balance's sign."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    c = table(spark, sf_dir, "customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))  # nation has a fixed size
    c, none = _numbered(c, "c_mktsegment", "c_custkey"), F.lit("")
    return _cells(c, [(F.col("c_name"), none), (F.col("n_name"), F.col("n_name")), (F.when(F.col("c_acctbal") < 0, "-").otherwise("+"), none)])


def kg_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").filter("n_regionkey <> 4")
    return n.select(F.col("n_name").alias("link"), F.concat(F.lit("Q"), (1000 + F.col("n_nationkey")).cast("string")).alias("entity"), "n_nationkey", "n_regionkey")


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").filter("n_nationkey < 20").select(F.col("n_name").alias("title"), F.col("n_nationkey").cast("string").alias("page_id"))


def kg_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = lambda c: F.concat(F.lit("Q"), c.cast("string"))
    first = q(10 + F.col("n_regionkey"))
    types = F.when(F.col("n_nationkey") % 2 == 0, F.array(first, q(20 + F.col("n_nationkey") % 3))).otherwise(F.array(first))
    return kg_entity(spark, sf_dir).select("entity", types.alias("types"))


def hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes from part keys: k under k / 2, and under k / 8 where 8 divides k."""
    k = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("sub"))
    half = k.filter("sub >= 2").select("sub", F.floor(F.col("sub") / 2).alias("sup"))
    return half.unionByName(k.filter("sub >= 8 AND sub % 8 = 0").select("sub", F.floor(F.col("sub") / 8).alias("sup"))).distinct()


PART_GRID = """
p AS (SELECT *, p_brand AS table_id, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS INTEGER) AS row_id FROM part),
cells AS (
  SELECT table_id, row_id, 0 AS col_id, p_name AS text, CASE WHEN p_size % 3 = 0 THEN replace(p_name, ' ', '_') ELSE '' END AS link FROM p
  UNION ALL SELECT table_id, row_id, 1, p_type, p_type FROM p
  UNION ALL SELECT table_id, row_id, 2, CAST(p_size AS VARCHAR), '' FROM p
  UNION ALL SELECT table_id, row_id, 3, p_brand, '' FROM p
  UNION ALL SELECT table_id, row_id, 4, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE '' END, '' FROM p
  UNION ALL SELECT table_id, row_id, 5, 'Q' || CAST(p_partkey AS VARCHAR), '' FROM p)"""
ROW_GRID = """
p AS (SELECT *, p_brand AS table_id, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS INTEGER) AS row_id, p_partkey AS k FROM part),
cells AS (
  SELECT table_id, row_id, 0 AS col_id, CASE WHEN k % 11 = 0 THEN 'Grand Total' WHEN k % 13 = 0 THEN 'None' ELSE p_name END AS text FROM p
  UNION ALL SELECT table_id, row_id, 1, CASE WHEN k % 22 = 0 THEN 'TOTAL' WHEN k % 13 = 0 THEN 'none' WHEN k % 7 = 0 THEN p_name WHEN k % 5 = 0 THEN '-' ELSE p_type END FROM p
  UNION ALL SELECT table_id, row_id, 2, CASE WHEN k % 13 = 0 THEN 'None' WHEN k % 7 = 0 THEN p_name WHEN k % 5 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END FROM p
  UNION ALL SELECT table_id, row_id, 3, CASE WHEN k % 17 = 0 OR k % 7 = 0 THEN p_name WHEN k % 13 = 0 THEN 'NONE' ELSE p_brand END FROM p)"""
NATION_GRID = """
p AS (SELECT c.*, n.n_name, n.n_nationkey, n.n_regionkey, c_mktsegment AS table_id,
  CAST(row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1 AS INTEGER) AS row_id FROM customer c JOIN nation n ON c_nationkey = n_nationkey),
cells AS (
  SELECT table_id, row_id, 0 AS col_id, c_name AS text, '' AS link FROM p
  UNION ALL SELECT table_id, row_id, 1, n_name, n_name FROM p
  UNION ALL SELECT table_id, row_id, 2, CASE WHEN c_acctbal < 0 THEN '-' ELSE '+' END, '' FROM p),
kg AS (SELECT n_name AS link, 'Q' || CAST(1000 + n_nationkey AS VARCHAR) AS entity, n_nationkey, n_regionkey FROM nation WHERE n_regionkey <> 4),
titles AS (SELECT n_name AS title FROM nation WHERE n_nationkey < 20),
kt AS (SELECT entity, CASE WHEN n_nationkey % 2 = 0 THEN ['Q' || CAST(10 + n_regionkey AS VARCHAR), 'Q' || CAST(20 + n_nationkey % 3 AS VARCHAR)]
  ELSE ['Q' || CAST(10 + n_regionkey AS VARCHAR)] END AS types FROM kg),
linked AS (SELECT c.*, CASE WHEN c.link = '' THEN '' WHEN kg.entity IS NOT NULL THEN kg.entity WHEN t.title IS NOT NULL THEN '' ELSE 'NIL' END AS entity
  FROM cells c LEFT JOIN kg ON c.link = kg.link LEFT JOIN titles t ON c.link = t.title),
typed AS (SELECT l.*, coalesce(kt.types, CAST([] AS VARCHAR[])) AS types FROM linked l LEFT JOIN kt ON l.entity = kt.entity)"""
HIERARCHY = """
edges AS (SELECT p_partkey AS sub, p_partkey // 2 AS sup FROM part WHERE p_partkey >= 2
  UNION SELECT p_partkey, p_partkey // 8 FROM part WHERE p_partkey >= 8 AND p_partkey % 8 = 0),
steps AS (SELECT sub, sup, 1 AS level FROM edges UNION SELECT s.sub, e.sup, s.level + 1 FROM steps s JOIN edges e ON s.sup = e.sub),
closed AS (SELECT sub, sup, CAST(min(level) AS INTEGER) AS level FROM steps GROUP BY sub, sup),
depth AS (SELECT sub AS cls, CAST(1 + coalesce(max(level) FILTER (sub <> sup), 0) AS INTEGER) AS depth, count(*) AS n_ancestors FROM closed GROUP BY sub)"""
