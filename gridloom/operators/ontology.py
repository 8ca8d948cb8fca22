"""Class hierarchy: all ancestors, depth, order by specificity, popularity."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.sources.storage import stored

#: So many edges (two numbers each) are sent to all tasks; more are joined turn by turn.
MOST_EDGES = 2_000_000


def closure(edges: DataFrame, most_edges: int = MOST_EDGES) -> DataFrame:
    """(sub, sup) edges of numbers -> (sub, sup, level): every ancestor with its least number of steps.

    Ends on cycles too: in one, a class is its own ancestor. A hierarchy of at
    most ``most_edges`` goes to every task, and each climbs from its own classes
    without a shuffle; the hierarchy of a knowledge base has a few million edges
    at most. A larger one is joined level by level.
    """
    edges = stored(edges.select(F.col("sub").cast("long").alias("sub"), F.col("sup").cast("long").alias("sup")).distinct())
    if edges.count() > most_edges:
        return _joined_closure(edges)
    all_ = edges.orderBy("sub", "sup").toArrow()
    shared = edges.sparkSession.sparkContext.broadcast((all_["sub"].to_numpy(), all_["sup"].to_numpy()))
    return edges.select("sub").distinct().mapInArrow(_climbing(shared), "sub long, sup long, level int")


def _climbing(shared):
    def run(batches):
        below, above = shared.value
        for b in batches:
            for at in range(0, b.num_rows, 5000):
                sub = sup = b.column(0).slice(at, 5000).to_numpy()
                seen, level = np.empty((0, 2), np.int64), 0
                while len(sub):
                    level += 1
                    first, last = np.searchsorted(below, sup, "left"), np.searchsorted(below, sup, "right")
                    n = last - first
                    places = np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)
                    found = np.unique(np.stack([np.repeat(sub, n), above[places]], axis=1), axis=0)
                    both = np.concatenate([seen, found])
                    _, where = np.unique(both, axis=0, return_index=True)  # of equals the earlier one
                    new = np.sort(where[where >= len(seen)])
                    sub, sup = both[new, 0], both[new, 1]
                    seen = np.concatenate([seen, both[new]])
                    yield pa.RecordBatch.from_arrays([pa.array(sub), pa.array(sup), pa.array(np.full(len(sub), level, np.int32))], ["sub", "sup", "level"])

    return run


def _joined_closure(edges: DataFrame) -> DataFrame:
    """Each turn extends only the pairs found last; the seen ones are a union of the stored levels, so lineage stays short."""
    levels = [edges.withColumn("level", F.lit(1))]
    while True:
        seen = levels[0]
        for x in levels[1:]:
            seen = seen.unionByName(x)
        step = levels[-1].select("sub", F.col("sup").alias("via")).join(edges.select(F.col("sub").alias("via"), "sup"), "via").select("sub", "sup").distinct()
        step = stored(step.join(seen.select("sub", "sup"), ["sub", "sup"], "left_anti").withColumn("level", F.lit(len(levels) + 1)))
        if step.isEmpty():
            return seen
        levels.append(step)


def depths(closed: DataFrame) -> DataFrame:
    """cls, depth: one more than the farthest ancestor but itself."""
    far = F.max(F.when(F.col("sub") != F.col("sup"), F.col("level")))
    return closed.groupBy(F.col("sub").alias("cls")).agg((1 + F.coalesce(far, F.lit(0))).alias("depth"), F.count(F.lit(1)).alias("n_ancestors"))


def popularity(objects: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """cls, n of each object, the most frequent first, ties to the smaller; at most k."""
    out = objects.groupBy(F.col(column).alias("cls")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "cls")
    return out.limit(k) if k else out


def relation(pairs: DataFrame, closed: DataFrame, depth: DataFrame) -> DataFrame:
    """(a, b) -> + order: 0 equal, 1 if b is an ancestor of a, -1 if a is one of b, else the difference of depths.

    A closure has many rows for each class, which no estimate from its edges
    tells, so it is always joined by sorting and never sent to all tasks.
    """
    up = closed.select(F.col("sub").alias("a"), F.col("sup").alias("b"), F.lit(True).alias("up")).hint("merge")
    down = closed.select(F.col("sup").alias("a"), F.col("sub").alias("b"), F.lit(True).alias("down")).hint("merge")
    d = lambda s: depth.select(F.col("cls").alias(s), F.col("depth").alias(f"depth_{s}"))
    out = pairs.join(up, ["a", "b"], "left").join(down, ["a", "b"], "left").join(d("a"), "a", "left").join(d("b"), "b", "left")
    order = F.when(F.col("a") == F.col("b"), 0).when(F.col("up"), 1).when(F.col("down"), -1).otherwise(F.col("depth_a") - F.col("depth_b"))
    return out.select("a", "b", order.alias("order"))


def by_specificity(depth: DataFrame, partition: list[str]):
    """Rank from generic to specific: by number of ancestors, depth and id, a total order in which ancestors come first."""
    return F.row_number().over(Window.partitionBy(*partition).orderBy("n_ancestors", "depth", "cls"))
