"""Exact top-k by integer inner product: distributed selection over score histograms.

Every query is scored against every vector, block by block. A first pass counts
scores in a global histogram for each query; the bin that holds the kth best
score becomes the next pass's range, until the bin has one value or its whole
content belongs to the answer. A last pass emits the scores at or above that
value, and ties go to the smaller id.

Blocks bound the memory: vectors are packed into blocks of at most ROWS rows,
queries into blocks of about QUERIES rows, and at most QUERY_BLOCKS of these, of
at most BROADCAST bytes, are broadcast at a time. A block
contributes no bins below its own kth best score, which is never below the
global one, and no more than k rows for each query to the last pass, so equal
vectors, however many, aren't gathered anywhere.

Rows with a null id or vector, or with a null or non-finite component, take no
part. Vectors of different lengths are compared as if padded with zeros; an
empty vector scores 0. A query's own row is known by its id: rows with the same
id aren't candidates for it. If an id repeats among the queries, its smallest
vector is the query. Scores have to fit 53 bits; if they might not, ValueError
is raised. Empty tables give an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, stored

ROWS, QUERIES, QUERY_BLOCKS, BINS = 2048, 512, 64, 64
BROADCAST = 64_000_000


def quantised(vector: Column) -> Column:
    """floor(256 * x) of each component, x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 256.0))


def usable(vector: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad)


def _matrix(lists, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width))
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def _packed(width: int):
    def pack(batches):
        ids, rows, held = [], [], 0
        for b in batches:
            ids.append(np.asarray(b.column(0)))
            rows.append(_matrix(b.column(1).to_pylist(), width))
            held += b.num_rows
            if held >= ROWS:
                i, m = np.concatenate(ids), np.concatenate(rows)
                for at in range(0, held - held % ROWS, ROWS):
                    yield block(i[at : at + ROWS], m[at : at + ROWS])
                ids, rows, held = [i[held - held % ROWS :]], [m[held - held % ROWS :]], held % ROWS
        if held:
            yield block(np.concatenate(ids), np.concatenate(rows))

    def block(i, m):
        return pa.RecordBatch.from_arrays([pa.array([i.astype(np.int64).tobytes()]), pa.array([m.tobytes()])], ["ids", "vectors"])

    return pack


def _scores(row, width: int):
    ids, m = np.frombuffer(row.ids, np.int64), np.frombuffer(row.vectors).reshape(-1, width)
    q = _matrix([x["vector"] for x in row.queries], width)
    own = np.array([x["query_id"] for x in row.queries], np.int64)
    return ids, own, np.rint(q @ m.T).astype(np.int64), ids[None, :] != own[:, None]


def _histogram(width: int):
    def count(batches):
        for pdf in batches:
            for row in pdf.itertuples():
                _, own, scores, fair = _scores(row, width)
                out = []
                for i, x in enumerate(row.queries):
                    lo, step, need = x["lo"], x["step"], x["need"]
                    s = scores[i][fair[i]]
                    s = s[(s >= lo) & (s < x["hi"])]
                    n = np.bincount((s - lo) // step, minlength=BINS)[::-1]
                    above = np.cumsum(n) - n
                    for b in np.flatnonzero((n > 0) & (above < need)):
                        out.append((own[i], BINS - 1 - b, n[b]))
                yield pd.DataFrame(out, columns=["query_id", "bin", "n"])

    return count


def _chosen(width: int, k: int):
    def choose(batches):
        for pdf in batches:
            for row in pdf.itertuples():
                ids, own, scores, fair = _scores(row, width)
                out = []
                for i, x in enumerate(row.queries):
                    at = np.flatnonzero(fair[i] & (scores[i] >= x["lo"]))
                    at = at[np.lexsort((ids[at], -scores[i][at]))[:k]]
                    out.append(pd.DataFrame({"query_id": own[i], "vec_id": ids[at], "score": scores[i][at]}))
                yield pd.concat(out)

    return choose


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """vectors, queries: (vec_id long, vector array of whole numbers) -> query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    facts = vectors.agg(F.max(F.size("vector")).alias("width"), F.max(norm).alias("norm")).first()
    asked = queries.agg(F.count_distinct("vec_id").alias("n"), F.max(F.size("vector")).alias("width"), F.max(norm).alias("norm")).first()
    width = max(facts.width or 0, asked.width or 0, 1)
    blocks = -(-(asked.n or 0) // QUERIES)
    # By Cauchy and Schwarz no score is beyond this.
    most = int(np.sqrt((facts.norm or 0.0) * (asked.norm or 0.0))) + 2
    if most >= 1 << 53:
        raise ValueError("scores may need more than 53 bits")
    step = -(-(2 * most) // BINS)
    together = max(1, min(QUERY_BLOCKS, BROADCAST // (QUERIES * width * 8)))
    vectors = vectors.select("vec_id", "vector").repartition(shuffle_partitions(spark))
    packed = stored(vectors.mapInArrow(_packed(width), "ids binary, vectors binary"))
    asked_rows = queries.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))
    asked_rows = stored(asked_rows.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(max(blocks, 1))).cast("int")))
    state = asked_rows.select("query_id", F.lit(-most).cast("long").alias("lo"), F.lit(most).cast("long").alias("hi"), F.lit(step).cast("long").alias("step"), F.lit(k).cast("long").alias("need"), F.lit(False).alias("done"))

    def paired(state: DataFrame, run, schema: str) -> DataFrame:
        """Each block of vectors with each block of queries; broadcast chunks of bounded size."""
        groups = asked_rows.join(state, "query_id").groupBy("block").agg(F.collect_list(F.struct("query_id", "vector", "lo", "hi", "step", "need")).alias("queries"))
        out = None
        for at in range(0, max(blocks, 1), together):
            last = min(at + together, max(blocks, 1)) - 1
            left = packed.withColumn("block", F.explode(F.sequence(F.lit(at), F.lit(last))))
            part = left.join(F.broadcast(groups.filter(F.col("block").between(at, last))), "block").mapInPandas(run, schema)
            out = part if out is None else out.unionByName(part)
        return out

    while True:
        open_ = state.filter(~F.col("done"))
        counts = paired(open_, _histogram(width), "query_id long, bin int, n long").groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query_id").orderBy(F.col("bin").desc())
        ranked = counts.withColumn("upto", F.sum("n").over(down))
        # Only the bin of the kth value, or the lowest one if there are fewer than k.
        found = ranked.join(open_, "query_id").filter((F.col("upto") - F.col("n") < F.col("need")))
        found = found.groupBy("query_id").agg(F.min(F.struct("bin", "n", "upto")).alias("at"))
        low = F.when(F.col("at").isNull(), F.col("lo")).otherwise(F.col("lo") + F.col("at.bin") * F.col("step"))
        now = open_.join(found, "query_id", "left").select(
            "query_id",
            low.alias("lo"),
            F.least("hi", low + F.col("step")).alias("hi"),  # what is above has been counted
            F.ceil(F.col("step") / F.lit(BINS)).cast("long").alias("step"),
            F.coalesce(F.col("need") - (F.col("at.upto") - F.col("at.n")), F.col("need")).alias("need"),
            (F.col("at").isNull() | (F.col("step") == 1) | (F.col("at.upto") <= F.col("need"))).alias("done"),
        )
        state = stored(state.filter("done").unionByName(now))
        if state.filter(~F.col("done")).limit(1).count() == 0:
            break
    kept = paired(state, _chosen(width, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    vectors = rows.select("vec_id", quantised(F.col("embedding")).alias("vector"))
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), 5)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
