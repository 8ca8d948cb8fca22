"""Document fingerprints: SimHash of weighted word pairs, and search by permuted block tables.

A document's terms are its pairs of neighbouring words (a single word is its
own pair), weighted by how often they occur. Each term's hash votes on BITS
signed sums; their signs are the fingerprint, written in hexadecimal. The share
of different bits estimates the angle between two documents' term vectors, and
``likeness`` is the cosine of that angle, 0 at least.

A null text counts as empty; a text without words has the fingerprint of zeros
only, like itself alone. Whole texts are read. Repeated rows give repeated rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, stored

BITS = 256
_LANES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_NEXT = np.uint64(0xFF51AFD7ED558CCD)


class _Hashes(dict):
    """64-bit hashes of words; forgets them all when there are too many."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode())
        return h


_hashes = _Hashes()


def fingerprint(text: str | None) -> bytes:
    """The BITS signs of one text."""
    words = (text or "").split()
    if not words:
        return bytes(BITS // 8)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    if len(h) > 1:
        h = h[:-1] * _NEXT + (h[1:] ^ (h[1:] >> np.uint64(29)))
    x = h[:, None] * _LANES
    x ^= x >> np.uint64(32)
    x *= _NEXT
    x ^= x >> np.uint64(29)
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(x), 255):  # so that eight bits hold the sums
        part = np.unpackbits(x[at : at + 255].view(np.uint8).reshape(-1, BITS // 8), axis=1)
        votes += np.add.reduce(part, axis=0, dtype=np.uint8)
    return np.packbits(2 * votes > len(x)).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    if a == b:
        return 1.0
    if not any(a) or not any(b):
        return 0.0
    apart = (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()
    return max(0.0, math.cos(math.pi * apart / BITS))


def edited(text: str, other: str) -> str:
    """text with its last third replaced by as much of other's beginning."""
    n = len(text) // 3
    return text[: len(text) - n] + other[:n]


_FIELDS = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_EDGE = [("part", pa.int32()), ("edge", pa.int32()), ("text", pa.string())]
_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _row(doc_id, text: str, own: bytes, other: str, next_own: bytes) -> tuple:
    changed = edited(text, other)
    print_ = fingerprint(changed)
    return doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), own.hex(), print_.hex(), likeness(own, print_), likeness(own, next_own)


def _batch(rows: list[tuple], fields) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def _in_order(batches):
    """Rows in order: each is edited with the next; a partition's first and last go out with their texts."""
    from pyspark import TaskContext

    part, held, none = TaskContext.get().partitionId(), None, (None,) * 3
    for b in batches:
        rows = []
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            text = text or ""
            own = fingerprint(text)
            if held is None:
                rows.append((doc_id, *(None,) * 6, part, 0, text))
            else:
                rows.append((*_row(*held, text, own), *none))
            held = (doc_id, text, own)
        yield _batch(rows, _FIELDS + _EDGE)
    if held is not None:
        yield _batch([(held[0], *(None,) * 6, part, 1, held[1])], _FIELDS + _EDGE)


def _pairs(batches):
    for b in batches:
        rows = [_row(i, x or "", fingerprint(x), y or "", fingerprint(y)) for i, x, y in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        yield _batch(rows, _FIELDS)


def edit_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text -> each text's fingerprint, its edited text's, and how like they and the next text's are.

    The next document is the one after it in descending doc_id (ties by a hash of
    the text), after the last the first. One range shuffle brings neighbours
    together; a partition's last row is joined to the next partition's first.
    """
    spark = docs.sparkSession
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    ranged = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    made = stored(ranged.mapInArrow(_in_order, f"{_SCHEMA}, part int, edge int, text string"))
    edges = made.filter("edge IS NOT NULL")
    firsts = edges.filter("edge = 0").select("part", F.col("text").alias("head"))
    lasts = edges.filter("edge = 1").select("part", "doc_id", "text")
    # Which partition comes next: a number for each partition; the texts are joined to it.
    by_part = Window.orderBy("part")
    every = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select("part", F.coalesce(F.lead("part").over(by_part), F.first("part").over(every)).alias("after"))
    joined = lasts.join(after, "part").join(firsts.select(F.col("part").alias("after"), F.col("head").alias("next")), "after")
    return made.filter("edge IS NULL").select(*[n for n, _ in _FIELDS]).unionByName(joined.select("doc_id", "text", "next").mapInArrow(_pairs, _SCHEMA))


def _plain(batches):
    for b in batches:
        rows = [(i, len(x or ""), fingerprint(x).hex()) for i, x in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        yield _batch(rows, [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("fingerprint", pa.string())])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text -> doc_id, n_chars, fingerprint."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_plain, "doc_id long, n_chars long, fingerprint string")


def _apart(a: Column, b: Column) -> Column:
    """Different bits of two fingerprints, 15 hexadecimal digits at a time."""
    digits, total = BITS // 4, F.lit(0)
    for at in range(0, digits, 15):
        n = min(15, digits - at)
        x, y = (F.conv(F.substring(c, at + 1, n), 16, 10).cast("long") for c in (a, b))
        total = total + F.bit_count(x.bitwiseXOR(y))
    return total


def near_pairs(prints: DataFrame, radius: int = 7) -> tuple[DataFrame, DataFrame]:
    """doc_id, fingerprint -> (pairs of classes within radius bits, members of each class).

    A class is a distinct fingerprint, named by its smallest doc_id. Two
    fingerprints at most radius bits apart agree in one of radius + 1 blocks
    (for radius 1, 3, 7, 15), so radius + 1 tables keyed by a block find every
    pair; a pair is kept at the first block that it shares. Copies are members
    of one class and never pair. Null ids come last in a class, null fingerprints
    are a class without pairs.
    """
    width = BITS // 4 // (radius + 1)
    if width * (radius + 1) * 4 != BITS:
        raise ValueError("radius + 1 must divide the hexadecimal digits")
    classes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("class_id"))
    members = prints.join(classes, "fingerprint").select("doc_id", "class_id")
    block = lambda c, i: F.substring(c, i * width + 1, width)
    keyed = classes.select("class_id", "fingerprint", F.posexplode(F.array(*[block(F.col("fingerprint"), i) for i in range(radius + 1)])).alias("table", "key"))
    a, b = keyed.alias("a"), keyed.alias("b")
    both = a.join(b, (F.col("a.table") == F.col("b.table")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.fingerprint") < F.col("b.fingerprint")))
    apart = _apart(F.col("a.fingerprint"), F.col("b.fingerprint"))
    first = F.coalesce(*[F.when(block(F.col("a.fingerprint"), i) == block(F.col("b.fingerprint"), i), F.lit(i)) for i in range(radius + 1)])
    pairs = both.filter((apart <= radius) & (first == F.col("a.table")))
    ids = [F.col("a.class_id"), F.col("b.class_id")]
    return pairs.select(F.least(*ids).alias("class_a"), F.greatest(*ids).alias("class_b"), apart.alias("bits")), members


def links_within(docs: DataFrame, radius: int = 7) -> DataFrame:
    """doc_id, text -> doc_id, class_id, n_links: how many other fingerprints lie within radius bits of a document's own."""
    pairs, members = near_pairs(fingerprints(docs), radius)
    ends = pairs.select(F.explode(F.array("class_a", "class_b")).alias("class_id")).groupBy("class_id").agg(F.count(F.lit(1)).alias("n_links"))
    return members.join(ends, "class_id", "left").select("doc_id", "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def fingerprint_links(spark, sf_dir: str) -> DataFrame:
    return links_within(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op7(spark, sf_dir: str) -> DataFrame:
    return edit_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
