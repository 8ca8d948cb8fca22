"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Each source's target follows from water-filling: all sources share a budget by
weight, a source stops at a multiple of its own size, and what it leaves over
goes to the others by weight until none is above. Within a source every
document expects ``target / source_size`` copies; a running sum of these
expectations plus one random offset crosses an integer as often as the document
is emitted. Documents are taken in order of size, so the words taken differ from
the target by about one document's size at most.

The running sum needs each document's rank within its source. One source may
hold a third of all rows, so no window runs over a source: rows are
range-partitioned by (source, size, doc_id), numbered within their partition,
and the partitions' counts are added up in a table of one row for each
partition and source.

Nulls: a null text has size 0; a null source is a source of its own, last in
order; a null doc_id sorts first. An empty table gives an empty result.
Repeated rows each count. Extra columns, whatever their names, are ignored by
``mix_plan`` and kept by ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, stored

#: Weights by position in the order of sources, repeating.
WEIGHTS = (5, 2, 1)
#: The mix has this share of all words.
BUDGET = 1.5
#: A source's target is at most so many times its size.
MOST = 2.0
SEED = "mix-1"


def size_of(text: Column) -> Column:
    """Number of runs of characters other than space and U+0009 to U+000D."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def offset_of(source: Column, seed: str = SEED) -> Column:
    """A source's random offset in [0, 1): 20 bits of a hash, exact as a double."""
    name = F.concat(F.lit(seed), F.coalesce(F.concat(F.lit(":"), source), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 5), 16, 10).cast("double") / F.lit(1048576.0)


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, most: float = MOST) -> DataFrame:
    """(source, source_size) -> + weight, target. The table has a row for each source.

    A source is capped if even the level at which it would just be full is no
    higher than the level that the remaining budget allows. In order of
    cap / weight the capped ones come first, so one running sum finds the level.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("place"), F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("place", F.row_number().over(by_name) - 1).withColumn("weight", weight)
    s = s.withColumn("cap", F.lit(most) * F.col("source_size"))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.lit(budget) * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    s = s.withColumn("level", left / F.sum("weight").over(rest))
    # The level is right at the first source in this order that it doesn't fill.
    full = F.col("level") * F.col("weight") >= F.col("cap")
    s = s.withColumn("water", F.min(F.when(~full, F.struct((F.col("cap") / F.col("weight")).alias("at"), "place", "level"))).over(every)["level"])
    target = F.when(full | F.col("water").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("water") * F.col("weight")))
    return s.select("source", "source_size", "weight", target.alias("target"))


def mix_plan(docs: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, most: float = MOST, seed: str = SEED) -> DataFrame:
    """doc_id, source, text (any further columns) -> doc_id, source, size, source_size, target, copies, taken for each row."""
    spark = docs.sparkSession
    sized = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"))
    order = [F.col("source").asc_nulls_last(), "size", "doc_id"]
    ranged = sized.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    ranged = stored(ranged.select("doc_id", "source", "size", F.shiftright(at, 33).alias("part"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("place")))
    # A partition holds consecutive ranks of each source: its first place and count are enough.
    counts = ranged.groupBy("part", "source").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"), F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", "source", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    sizes = counts.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, budget, most).select(F.col("source").alias("s"), "source_size", "target")
    frame = starts.join(targets, F.col("source").eqNullSafe(F.col("s"))).select(F.col("part").alias("p"), "s", "shift", "source_size", "target")
    rows = ranged.join(frame, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rank = F.col("place") + F.col("shift")
    crossed = F.floor(F.col("u") + F.col("rate") * (F.col("rank") + 1)) - F.floor(F.col("u") + F.col("rate") * F.col("rank"))
    rows = rows.withColumns({"rate": rate, "rank": rank, "u": offset_of(F.col("source"), seed)})
    rows = rows.withColumn("copies", F.least(crossed, F.ceil(F.lit(most)).cast("long")))
    return rows.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The rows of the mix: each row of docs as often as it is emitted, columns unchanged.

    Rows are matched to their copies by (doc_id, source, size); rows alike in
    these share their copies in order of text, so that the total is kept.
    """
    plan = mix_plan(docs, **settings)
    per_key = plan.groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("alike"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), size_of(F.col("text")).alias("words"))
    same = F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & F.col("row.source").eqNullSafe(F.col("source")) & (F.col("words") == F.col("size"))
    both = rows.join(per_key, same)
    # Rows alike get the whole quotient each, and the first ones of them one more.
    alone = both.filter("alike = 1").select("row", F.col("copies").alias("times"))
    nth = F.row_number().over(Window.partitionBy("doc_id", "source", "size").orderBy("row.text")) - 1
    shared = both.filter("alike > 1").select("row", (F.floor(F.col("copies") / F.col("alike")) + (nth < F.col("copies") % F.col("alike")).cast("long")).alias("times"))
    out = alone.unionByName(shared).filter("times > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("row.*")


def op6(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_plan(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


SIZE_SQL = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

#: ``{rows}`` stands for a query with doc_id, source and text.
MIX_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST({SIZE_SQL} AS BIGINT) AS size FROM ({{rows}})
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), placed AS (
  SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS place FROM sizes
), weighed AS (
  SELECT *, CAST([5, 2, 1][1 + place % 3] AS DOUBLE) AS weight, 2.0::DOUBLE * source_size AS cap FROM placed
), levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed
), water AS (
  SELECT arg_min(level, (cap / weight, place)) AS water FROM levels WHERE level * weight < cap
), targets AS (
  SELECT source, source_size,
    CASE WHEN level * weight >= cap OR water IS NULL THEN cap ELSE least(cap, water * weight) END AS target
  FROM levels, water
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) - 1 AS rank FROM sized
), rated AS (
  SELECT r.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
    CAST(('0x' || substr(md5('{SEED}' || coalesce(':' || r.source, '')), 1, 5)) AS BIGINT) / 1048576.0::DOUBLE AS u
  FROM ranked r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
), counted AS (
  SELECT *, CAST(least(floor(u + rate * (rank + 1)) - floor(u + rate * rank), 2) AS BIGINT) AS copies FROM rated
)
"""

OP6_SQL = MIX_SQL.format(rows="SELECT doc_id, source, text FROM documents") + """
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM counted
"""
