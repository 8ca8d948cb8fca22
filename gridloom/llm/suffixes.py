"""Removal of repeated byte strings by a sparse, distributed suffix array.

A byte goes if it is covered by a string of LENGTH bytes that also starts
earlier: in a document of smaller doc_id, or in the same one further left.

Of the suffixes only those at anchors are sorted. A string of LENGTH bytes has
one anchor, the leftmost smallest hash of its runs of GRAM bytes, so equal
strings have anchors at the same place in them, and comparing the suffixes that
share an anchor's leading bytes compares all equal strings. An anchor stands for
the strings that have it, a stretch of neighbouring starts, about 38 on average.

1. Anchors go to buckets by their leading eight bytes, between splitters sampled
   from documents. Leading bytes that fill several buckets are dealt to all of
   them by document.
2. A bucket sorts its anchors by hashes of the leading bytes, then of the whole
   stretch. Of equal stretches all but the first go. If leading bytes have
   different stretches, or lie on both sides of a bucket's boundary, the first of
   each stretch goes on to be compared.
3. Those are fetched as bytes, and their strings sorted by multikey quicksort on
   words of eight bytes within equal leading bytes and place of the anchor;
   of equal strings all but the first go. An anchor that more than HOT different
   stretches have is dealt out string by string, so that no task gets it whole.

Buckets are as many as shuffles have partitions, or more, for BUCKET bytes of
documents each.

Stretches found equal in step 2 have equal 64-bit hashes of at most 177 bytes;
no two different ones are expected among 10^9. Step 3 compares bytes.

A null text counts as empty. Rows with equal doc_id and text are one document;
different texts with one doc_id come in order of a hash of the text, a null
doc_id first. Matches never cross documents. Extra columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, small_side, stored

LENGTH, GRAM = 100, 24
_WINDOW = LENGTH - GRAM + 1
#: So many bytes of documents are looked at together, and so many documents sampled for the splitters.
_CHUNK, _SAMPLE = 1 << 19, 400
#: Anchors of a sampled document that are looked at; stretches of one anchor that go to one task; bytes of documents for a bucket.
_LEADS, HOT, BUCKET = 256, 20_000, 64 << 20
_WIDE = 1 << 62  # marks an anchor whose leading bytes fill several buckets

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_S32, _S29 = np.uint64(32), np.uint64(29)
_M1, _M2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xFF51AFD7ED558CCD)


class _Powers:
    """Powers of the base and its inverse, and a random word for each byte."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)
        self.byte = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            for name, x in (("up", _BASE), ("down", _INVERSE)):
                p = np.full(n, x, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))


_powers = _Powers()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S32)) * _M1
    x = (x ^ (x >> _S29)) * _M2
    return x ^ (x >> _S32)


def anchors(data: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """Anchors of the documents that lie one after another in data, up to ends.

    first, last: starts of the first and last string that has the anchor; at:
    where the anchor is; key, stretch: hashes of the leading bytes and of all of
    these strings' bytes; lead: the leading eight bytes; doc: number of the document.
    """
    n = len(data)
    none = np.empty(0, np.int64)
    if n < LENGTH:
        return {"first": none, "last": none, "at": none, "doc": none, "key": none.view(np.uint64), "stretch": none.view(np.uint64), "lead": none.view(np.uint64)}
    _powers.reach(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_powers.byte[data] * _powers.up[:n], out=sums[1:])
    gram = _mix((sums[GRAM:] - sums[:-GRAM]) * _powers.down[: n - GRAM + 1])
    bits = np.uint64(max(1, (n - 1).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    least = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)  # ties to the left
    width = 1
    while width < _WINDOW:
        step = min(width, _WINDOW - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    at = (least & low).astype(np.int64)  # for each start of a string
    whole = np.ones(len(at), bool)  # the string lies in one document
    for e in ends[:-1]:
        whole[max(0, e - LENGTH + 1) : e] = False
    at[~whole] = -1
    turn = np.flatnonzero(np.diff(at)) + 1
    first = np.concatenate([[0], turn])
    last = np.concatenate([turn, [len(at)]]) - 1
    real = at[first] >= 0
    first, last = first[real], last[real]
    at = at[first]
    span = last + LENGTH - first
    stretch = (sums[last + LENGTH] - sums[first]) * _powers.down[first]
    stretch = _mix(stretch + (span * 256 + at - first).astype(np.uint64) * _M1)
    lead = np.zeros(len(at), np.uint64)
    for i in range(8):
        lead = (lead << np.uint64(8)) | data[at + i].astype(np.uint64)
    return {"first": first, "last": last, "at": at, "doc": np.searchsorted(ends, first, side="right"), "key": gram[at], "stretch": stretch, "lead": lead}


def _chunks(batches):
    """(ids, bytes, ends, starts) of rows of (rid, text), about _CHUNK bytes at a time."""
    ids, texts, held = [], [], 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
            ids.append(i)
            texts.append(t or b"")
            held += len(texts[-1])
            if held >= _CHUNK:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def _anchored(splitters: np.ndarray):
    def run(batches):
        for ids, texts in _chunks(batches):
            ends = np.cumsum([len(t) for t in texts])
            a = anchors(np.frombuffer(b"".join(texts), np.uint8), ends)
            doc = np.array(ids, np.int64)[a["doc"]]
            lo, hi = np.searchsorted(splitters, a["lead"], side="left"), np.searchsorted(splitters, a["lead"], side="right")
            spread = _mix(doc.astype(np.uint64) + _M1) % (hi - lo + 1).astype(np.uint64)
            bucket = lo + np.where(hi > lo, spread.astype(np.int64), 0)
            start = a["first"] - (ends - [len(t) for t in texts])[a["doc"]]
            at = (start << 16) | (a["at"] - a["first"] << 8) | (a["last"] - a["first"]) | np.where(hi > lo, _WIDE, 0)
            yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), pa.array(a["key"].view(np.int64)), pa.array(a["stretch"].view(np.int64)), pa.array(doc), pa.array(at)], ["bucket", "key", "stretch", "rid", "at"])

    return run


def _sorted_bucket(batches):
    """One bucket's anchors -> repeats (rid, start, length, no key) and what is to be compared (rid, start, at, key)."""
    held = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
    if not held:
        return
    bucket, key, stretch, rid, at = (np.concatenate(x) for x in zip(*held, strict=True))
    del held
    order = np.lexsort((at & (_WIDE - 1), rid, stretch, key))
    bucket, key, stretch, rid, at = (x[order] for x in (bucket, key, stretch, rid, at))
    new_key = np.ones(len(key), bool)
    new_key[1:] = key[1:] != key[:-1]
    new = new_key.copy()
    new[1:] |= stretch[1:] != stretch[:-1]
    # Rows alike in everything are one document's.
    alike = np.zeros(len(key), bool)
    alike[1:] = ~new[1:] & (rid[1:] == rid[:-1]) & (at[1:] == at[:-1])
    which = np.cumsum(new_key) - 1
    mixed = np.bincount(which, weights=new)[which] > 1
    wide = (at & _WIDE) != 0
    mixed |= wide
    at &= _WIDE - 1
    start, inner, reach = at >> 16, (at >> 8) & 255, at & 255
    gone = ~new & ~alike
    # An alike row of a first one is itself first.
    for i in np.flatnonzero(alike):
        gone[i] = gone[i - 1]
    go_on = new & mixed
    for rows, known in ((gone, False), (go_on, True)):
        w = np.flatnonzero(rows)
        for lo in range(0, len(w), 200_000):
            part = w[lo : lo + 200_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rid[part]), pa.array(start[part]), pa.array(reach[part] + LENGTH), pa.array(inner[part]), pa.array(key[part]) if known else pa.nulls(len(part), pa.int64())],
                ["rid", "start", "length", "inner", "key"],
            )


def _leads(batches):
    """rid, text -> the leading bytes of some anchors of each, those of the smallest hashes."""
    for _, texts in _chunks(batches):
        a = anchors(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts]))
        order = np.lexsort((a["key"], a["doc"]))
        doc = a["doc"][order]
        place = np.arange(len(doc)) - np.searchsorted(doc, doc)
        yield pa.RecordBatch.from_arrays([pa.array(a["lead"][order][place < _LEADS].view(np.int64))], ["lead"])


def _fetched(batches):
    """rid, text, list of (start, length, inner, key, hot) -> key, rid, start, inner, bytes."""
    for b in batches:
        for at in range(0, b.num_rows, 200):
            part = b.slice(at, 200)
            keys, rids, starts, inners, texts = [], [], [], [], []
            for rid, text, rows in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), part.column(2), strict=True):
                v = rows.values
                s, n, i, k = (v.field(x).to_numpy() for x in ("start", "length", "inner", "key"))
                hot = v.field("hot").to_numpy(zero_copy_only=False)
                if hot.any():  # string by string, named by itself and the anchor's place in it
                    many = n[hot] - LENGTH + 1
                    row = np.repeat(np.flatnonzero(hot), many)
                    step = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                    at, inner = s[row] + step, i[row] - step
                    names = [xxhash.xxh64_intdigest(text[x : x + LENGTH], y) for x, y in zip(at.tolist(), inner.tolist(), strict=True)]
                    k = np.concatenate([k[~hot], np.array(names, np.uint64).view(np.int64)])
                    s, i, n = np.concatenate([s[~hot], at]), np.concatenate([i[~hot], inner]), np.concatenate([n[~hot], np.full(len(row), LENGTH)])
                keys.append(k)
                starts.append(s)
                inners.append(i)
                rids.append(np.full(len(k), rid, np.int64))
                texts.extend(text[x : x + y] for x, y in zip(s.tolist(), n.tolist(), strict=True))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(rids)), pa.array(np.concatenate(starts)), pa.array(np.concatenate(inners)), pa.array(texts, pa.binary())], ["key", "rid", "start", "inner", "bytes"])


def multikey_order(group: np.ndarray, word, words: int, tie: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(order, whether equal to the one before) of strings by group, then by bytes, then by tie.

    word(i, rows) gives the ith eight bytes of rows as numbers. Each turn looks at
    one more word, of those rows only whose group and words so far aren't theirs
    alone: multikey quicksort, a word of a level at a time.
    """
    order = np.lexsort((*tie, group))
    g = group[order]
    same = np.zeros(len(g), bool)
    same[1:] = g[1:] == g[:-1]
    for i in range(words):
        open_ = same.copy()
        open_[:-1] |= same[1:]
        at = np.flatnonzero(open_)
        if not len(at):
            break
        block = np.cumsum(~same[at])  # rows that are equal so far
        rows = order[at]
        w = word(i, rows)
        by = np.lexsort((np.arange(len(at)), w, block))  # ties stay in order
        order[at] = rows[by]
        w, block = w[by], block[by]
        same[at[1:]] &= (w[1:] == w[:-1]) & (block[1:] == block[:-1])
    return order, same


def _compared(batches):
    """key, rid, start, inner, bytes of whole keys -> repeats (rid, start, length)."""
    for key, rid, start, inner, texts in _key_groups(batches):
        sizes = np.array([len(t) for t in texts], np.int64)
        data = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
        begins = np.cumsum(sizes) - sizes
        number = sizes - LENGTH + 1  # strings in each
        row = np.repeat(np.arange(len(sizes)), number)
        place = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
        at = begins[row] + place
        # Equal strings have their anchor at the same place.
        group = _mix(key[row].view(np.uint64) + (inner[row] - place + 1).astype(np.uint64) * _M2)
        words = np.zeros(len(data) - 8, np.uint64)
        for i in range(8):
            words = (words << np.uint64(8)) | data[i : len(data) - 8 + i].astype(np.uint64)
        offsets = [*range(0, LENGTH - 7, 8)] + ([LENGTH - 8] if LENGTH % 8 else [])
        order, same = multikey_order(group, lambda i, r: words[at[r] + offsets[i]], len(offsets), (start[row] + place, rid[row]))
        # The first of equals stays, and what is at its very place.
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
        a, b = order, order[head]
        gone = np.zeros(len(order), bool)
        gone[a] = same & ((rid[row[a]] != rid[row[b]]) | (start[row[a]] + place[a] != start[row[b]] + place[b]))
        w = np.flatnonzero(gone)
        if len(w):
            cut = np.flatnonzero((np.diff(w) != 1) | (np.diff(row[w]) != 0))
            lo, hi = w[np.concatenate([[0], cut + 1])], w[np.concatenate([cut, [len(w) - 1]])]
            yield pa.RecordBatch.from_arrays([pa.array(rid[row[lo]]), pa.array(start[row[lo]] + place[lo]), pa.array(hi - lo + LENGTH)], ["rid", "start", "length"])


def _key_groups(batches, rows: int = 20_000):
    """Rows in order of key, some whole keys at a time."""
    held: list = []
    n = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n >= rows:
            t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            key = t.column(0).to_numpy()
            cut = int(np.searchsorted(key, key[-1], side="left"))
            if cut:
                yield _columns(t.slice(0, cut))
                held, n = [t.slice(cut)], len(key) - cut
            else:
                held = [t]
    if held:
        yield _columns(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


def _columns(t):
    return *(t.column(i).to_numpy() for i in range(4)), t.column(4).to_pylist()


def spans_of(starts: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    out: list[tuple[int, int]] = []
    order = np.argsort(starts, kind="stable")
    lo = starts[order]
    hi = np.maximum.accumulate(lo + lengths[order])
    cut = np.flatnonzero(lo[1:] > hi[:-1]) + 1
    for a, b in zip(np.concatenate([[0], cut]).tolist(), np.concatenate([cut, [len(lo)]]).tolist(), strict=True):
        out.append((int(lo[a]), int(hi[b - 1])))
    return out


def _cut(batches):
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.list_(pa.int64())))]
    for b in batches:
        for at in range(0, b.num_rows, 1000):
            part, out = b.slice(at, 1000), []
            for doc_id, text, rows in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), part.column(2), strict=True):
                text, spans = text or b"", []
                if rows.is_valid and len(rows.values):
                    spans = spans_of(rows.values.field("start").to_numpy(), rows.values.field("length").to_numpy())
                h, last = hashlib.sha256(), 0
                for lo, hi in spans:
                    h.update(text[last:lo])
                    last = hi
                h.update(text[last:])
                out.append((doc_id, len(text), sum(hi - lo for lo, hi in spans), len(spans), h.hexdigest(), [list(x) for x in spans]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out, strict=True), fields, strict=True)], [n for n, _ in fields])


def _release(spark) -> None:
    """Shuffle files of finished jobs go now, not whenever the driver's memory is next looked through."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def repeated_spans(docs: DataFrame) -> DataFrame:
    """rid (distinct, ordered), text -> rid, start, length of repeats; spans may overlap."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    buckets = max(shuffle_partitions(spark), -(-size // BUCKET))
    some = docs.filter(F.length("text") > 0).orderBy(F.xxhash64("rid")).limit(_SAMPLE).select("rid", "text")
    leads = np.sort(some.mapInArrow(_leads, "lead long").toArrow()["lead"].to_numpy().view(np.uint64))
    splitters = leads[np.arange(1, buckets) * len(leads) // buckets] if len(leads) else leads
    made = docs.select("rid", "text").mapInArrow(_anchored(splitters), "bucket int, key long, stretch long, rid long, at long")
    made = made.repartitionById(buckets, F.col("bucket")).mapInArrow(_sorted_bucket, "rid long, start long, length long, inner long, key long")
    first = stored(made)
    _release(spark)
    asked = first.filter("key IS NOT NULL")
    hot = small_side(stored(asked.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT).select("key", F.lit(True).alias("hot"))), 100_000)
    asked = asked.join(hot, "key", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    asked = asked.groupBy("rid").agg(F.collect_list(F.struct("start", "length", "inner", "key", "hot")).alias("rows"))
    fetched = docs.join(asked, "rid").select("rid", "text", "rows").mapInArrow(_fetched, "key long, rid long, start long, inner long, bytes binary")
    fetched = fetched.repartition(buckets, "key").sortWithinPartitions("key")
    second = stored(fetched.mapInArrow(_compared, "rid long, start long, length long"))
    _release(spark)
    return first.filter("key IS NULL").select("rid", "start", "length").unionByName(second)


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text -> doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans ([from, to) of the removed runs)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    odd = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR doc_id IS NULL").limit(1).count()
    if odd:  # number the different rows in order
        keyed = rows.withColumn("mark", F.xxhash64("text"))
        order = [F.col("doc_id").asc_nulls_first(), "mark"]
        keys = keyed.select("doc_id", "mark").distinct().repartitionByRange(shuffle_partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
        keys = stored(keys.withColumn("rid", F.monotonically_increasing_id()))
        rows = keyed.join(keys.withColumnsRenamed({"doc_id": "d", "mark": "m"}), F.col("doc_id").eqNullSafe(F.col("d")) & F.col("mark").eqNullSafe(F.col("m"))).select("rid", "doc_id", "text")
        one = rows.withColumn("n", F.row_number().over(Window.partitionBy("rid").orderBy("doc_id"))).filter("n = 1").select("rid", "text")
    else:
        rows = rows.select(F.col("doc_id").alias("rid"), "doc_id", "text")
        one = rows.select("rid", "text")
    spans = repeated_spans(one).groupBy("rid").agg(F.collect_list(F.struct("start", "length")).alias("spans"))
    return rows.join(spans, "rid", "left").select("doc_id", "text", "spans").mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>")


def op2(spark, sf_dir: str) -> DataFrame:
    return without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
