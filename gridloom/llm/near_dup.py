"""Near-duplicate documents: BagMinHash signatures, banding, exact multiset overlap.

A document is the multiset of its runs of five words (a shorter text is one run
of all its words). BagMinHash draws, for every run and every unit of its
weight, points of a Poisson process from hashes alone; each point falls into
one of the signature's registers, and a register keeps its earliest point. Two
registers agree with the probability of the weighted Jaccard similarity. The
weights are cut at 1, 2, 4, 8, ...: each stretch has a process of its own, and
in the stretch that ends above the weight a point counts if it lies below it.
All registers are filled by points up to a time that depends on the total
weight, so work stops there, and doubles the time in the rare other case.

Equal texts form one class and are hashed as one. Classes that agree in a band
of registers are candidates, and a link between two classes is a similarity of
0.8 or more by the multisets themselves, always counted in full. First each
class is held against one head: the member of its bands that meets most others.
What that connects needs no further look. The classes of bands that still hold
more than one component are open, and all similar pairs across components among
them are found by a prefix join: the runs of each class are ordered by the
number of open classes that have them, rarest first, and two classes of 0.8 or
more have a run in common among the first few of either, at places which leave
enough behind them. So a group of thousands is linked by about as many
comparisons, all pairs within it are never made, and no link between components
that a band shows is lost. A pair of similarity 0.8 shares no band with a
probability of 7e-5.

Texts without words are copies of each other (null counts as empty). Repeated
rows are copies. A null doc_id comes last in its class. Extra columns, whatever
their names, are ignored by ``near_duplicates`` and kept by ``deduplicated``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, small_side, stored

WORDS, SIMILAR = 5, 0.8
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
#: A head with more partners than this is dealt out over several tasks.
PARTNERS = 500
#: Up to so many keys are broadcast; more are shuffled.
MOST_KEYS = 500_000

_A, _B, _C, _D = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93))
_S30, _S27, _S31, _S11, _S32 = (np.uint64(x) for x in (30, 27, 31, 11, 32))
_M = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode())
        return h


_hashes = _Hashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S30)) * _A
    x = (x ^ (x >> _S27)) * _B
    return x ^ (x >> _S31)


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of the runs of five words, hashes ascending."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, n)
    if n < WORDS:
        return np.array([xxhash.xxh64_intdigest(h.tobytes(), n)], np.uint64), np.ones(1, np.int64)
    x = h[: n - WORDS + 1] * _M[0]
    for i in range(1, WORDS):
        x = (x ^ (x >> _S32)) * _M[i] + h[i : n - WORDS + 1 + i]
    return np.unique(_mix(x), return_counts=True)


def elements(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A multiset as a set: the kth copy of a run has a name of its own. Ascending, so that sets can be merged."""
    parts, k = [hashes], 1
    while len(at := np.flatnonzero(counts > k)):
        parts.append(_mix(hashes[at] + _C * np.full(1, k, np.uint64)))
        k += 1
    return np.unique(np.concatenate(parts).view(np.int64))


def signature(hashes: np.ndarray, counts: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """A 32-bit point name for each register; all zeros for an empty multiset."""
    out = np.zeros(registers, np.uint32)
    if not len(hashes):
        return out
    seeds, lows, highs, weights = [hashes], [np.zeros(len(hashes))], [np.ones(len(hashes))], [counts.astype(float)]
    low = 1
    while True:  # stretches [1, 2), [2, 4), [4, 8), ... of larger weights
        at = np.flatnonzero(counts > low)
        if not len(at):
            break
        seeds.append(hashes[at] + _D * np.full(len(at), low, np.uint64))
        lows.append(np.full(len(at), float(low)))
        highs.append(np.full(len(at), 2.0 * low))
        weights.append(counts[at].astype(float))
        low *= 2
    seed, low_, high, weight = (np.concatenate(x) for x in (seeds, lows, highs, weights))
    rate = high - low_
    until = (math.log(registers) + 3) * registers / float(counts.sum())
    while True:
        times, names, slots = _points(seed, low_, rate, weight, until, registers)
        order = np.argsort(-times, kind="stable")  # the earliest is written last
        filled = np.zeros(registers, bool)
        filled[slots] = True
        if filled.all():
            out[slots[order]] = names[order]
            return out
        until *= 2


def _points(seed, low, rate, weight, until, registers):
    """Time, name and register of every point before until."""
    got, at = [], np.arange(len(seed))
    now, step, many = np.zeros(len(seed)), 0, 1
    while len(at):
        steps = np.arange(step, step + many, dtype=np.uint64)
        h = _mix(seed[at][:, None] + _C * (steps + np.uint64(1)))
        wait = -np.log(((h >> _S11).astype(float) + 0.5) * 2.0**-53) / rate[at][:, None]
        t = np.cumsum(wait, axis=1) + now[:, None]
        r, c = np.nonzero(t < until)
        if len(r):
            name = _mix(h[r, c] ^ _D)
            where = low[at[r]] + rate[at[r]] * ((_mix(name) >> _S11).astype(float) * 2.0**-53)
            inside = where < weight[at[r]]
            name = name[inside]
            got.append((t[r, c][inside], (name >> _S32).astype(np.uint32) | np.uint32(1), ((name & np.uint64(0xFFFFFFFF)) * np.uint64(registers) >> _S32).astype(np.intp)))
        more = t[:, -1] < until
        at, now = at[more], t[more, -1]
        step += many
        many = int(min(256, until + 4 * math.sqrt(until) + 4))
    return tuple(np.concatenate(x) for x in zip(*got, strict=True)) if got else (np.empty(0), np.empty(0, np.uint32), np.empty(0, np.intp))


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets."""
    total = int(a[1].sum() + b[1].sum())
    if not total:
        return 1.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    return common / (total - common)


def _signed(batches):
    for b in batches:
        for at in range(0, b.num_rows, 2000):
            part = b.slice(at, 2000)
            signs, sizes = [], []
            for text in part.column(2).to_pylist():
                s = shingles(text)
                signs.append(signature(*s).tobytes())
                sizes.append(int(s[1].sum()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(signs, pa.binary()), pa.array(sizes, pa.int64())], ["doc_id", "key", "signature", "size"])


def _listed(batches):
    """key, text -> key, size, runs."""
    for b in batches:
        for at in range(0, b.num_rows, 1000):
            part = b.slice(at, 1000)
            sets = [elements(*shingles(x)) for x in part.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *sets])))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(ends).astype(np.int64)), lists], ["key", "size", "runs"])


def _alike(batches):
    """a, b, x, y: the pairs whose sets of runs x and y overlap enough."""
    for b in batches:
        (x, y), keep = (b.column(i).flatten().to_numpy() for i in (2, 3)), []
        ends = [np.concatenate([[0], np.cumsum(pa.compute.list_value_length(b.column(i)).to_numpy())]) for i in (2, 3)]
        for i in range(b.num_rows):
            m, n = (x[ends[0][i] : ends[0][i + 1]], y[ends[1][i] : ends[1][i + 1]])
            at = np.minimum(np.searchsorted(m, n), len(m) - 1)
            common = int(np.count_nonzero(m[at] == n))
            if common >= SIMILAR * (len(m) + len(n) - common):
                keep.append(i)
        yield b.select([0, 1]).take(pa.array(keep, pa.int64()))


def key_of(text: Column) -> Column:
    """A class's name: equal for equal texts; texts without words count as equal."""
    return F.md5(F.when(text.rlike(r"\S"), text).otherwise(F.lit("")))


def components(links: DataFrame) -> DataFrame:
    """links (a, b) -> (key, root) of each linked key; the root is the smallest key of its component.

    Large-star and small-star rounds, each a count of the smallest neighbour and
    a join; the links are written between rounds.
    """
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        again = large.join(small, "a")
        moved = again.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(again.select("a", F.col("m").alias("b")))
        edges = stored(moved.filter("a <> b").distinct())
        # Stars are what is sought: no key has two roots, and no root has one.
        twice = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        if twice.isEmpty() and edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty():
            break
    return edges.select(F.col("a").alias("key"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("key"), F.col("b").alias("root")).distinct())


def _close(a: str, b: str) -> Column:
    """Whether two sizes allow the similarity."""
    return F.least(F.col(a), F.col(b)) >= SIMILAR * F.greatest(F.col(a), F.col(b))


def verified(pairs: DataFrame, held: DataFrame, name: str) -> DataFrame:
    """Those pairs (a, b) of names whose runs overlap enough. held: name, runs.

    A name may be in very many pairs as a: its runs then go to several tasks,
    each of which has a part of its pairs.
    """
    kind = dict(held.dtypes)[name]
    many = small_side(stored(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > PARTNERS).select("a", F.ceil(F.col("n") / PARTNERS).cast("int").alias("parts"))), MOST_KEYS)
    dealt = pairs.join(many, "a", "left").select("a", "b", F.coalesce(F.pmod(F.xxhash64("b"), F.col("parts")), F.lit(0)).cast("int").alias("part"))
    sides = held.select(F.col(name).alias("a"), F.col("runs").alias("x")).join(pairs.select("a").distinct(), "a", "left_semi").join(many, "a", "left")
    sides = sides.select("a", "x", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
    both = dealt.join(held.select(F.col(name).alias("b"), F.col("runs").alias("y")), "b").join(sides, ["a", "part"])
    return both.select("a", "b", "x", "y").mapInArrow(_alike, f"a {kind}, b {kind}")


def candidates(held: DataFrame) -> DataFrame:
    """id, root, size, runs -> every pair (a, b) of ids of different roots that can be similar.

    A prefix join. With the runs of each in one order, the rarest first, two sets
    of 0.8 or more have a run among the first 0.2 of the longer one and the first
    ninth of the shorter one in common; and where their first common run stands,
    at least the overlap they need has to be left behind it in both. Runs that
    only one set has come first and are only counted. Pairs that are not similar
    can come out, none that is similar and across roots is missing.
    """
    runs = held.select("id", F.explode("runs").alias("run"))
    often = runs.groupBy("run").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = runs.join(often, "run").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "run"))).alias("shared"))
    shared = shared.join(held.select("id", "root", "size"), "id")
    # The share of a set that stays behind the prefix; sizes are whole numbers, so a billionth makes up for rounding.
    behind = lambda part: F.col("size") - F.ceil(F.lit(part) * F.col("size") - 1e-9) + 1
    alone = F.col("size") - F.size("shared")
    first = shared.select("id", "root", "size", alone.alias("alone"), behind(SIMILAR).alias("longer"), behind(2 * SIMILAR / (1 + SIMILAR)).alias("shorter"), "shared")
    first = first.filter("longer > alone").select("id", "root", "size", "alone", "shorter", F.posexplode(F.slice("shared", F.lit(1), (F.col("longer") - F.col("alone")).cast("int"))).alias("at", "x"))
    first = first.select("id", "root", "size", (F.col("alone") + F.col("at")).alias("at"), "shorter", F.col("x.run").alias("run"))
    side = lambda s: [F.col("run"), *(F.col(c).alias(f"{c}_{s}") for c in ("id", "root", "size", "at"))]
    one, two = first.filter("at < shorter").select(*side("a")), first.select(*side("b"))
    need = F.ceil(F.lit(SIMILAR / (1 + SIMILAR)) * (F.col("size_a") + F.col("size_b")) - 1e-9)
    fits = (F.col("size_b") * SIMILAR <= F.col("size_a")) & ((F.col("size_a") < F.col("size_b")) | (F.col("size_a") == F.col("size_b")) & (F.col("id_a") < F.col("id_b")))
    left = F.least(F.col("size_a") - F.col("at_a"), F.col("size_b") - F.col("at_b"))
    pairs = one.join(two, "run").filter((F.col("root_a") != F.col("root_b")) & fits & (left >= need))
    return pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()


def roots_of(signed: DataFrame, docs: DataFrame) -> DataFrame:
    """signed (key, signature, size) and docs (text) -> (key, root) of the keys that have links, by exact overlap."""
    classes = stored(signed.groupBy("key").agg(F.first("signature").alias("signature"), F.first("size").alias("size")).filter("size > 0"))
    band = [F.xxhash64(F.lit(i), F.substring(F.col("signature"), i * ROWS * 4 + 1, ROWS * 4)) for i in range(BANDS)]
    banded = classes.select("key", "size", F.explode(F.array(*band)).alias("band"))
    buckets = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = stored(banded.join(buckets, "band").select("band", "key", "size", "n"))
    met = stored(members.groupBy("key").agg(F.sum("n").alias("met")))
    texts = docs.select(key_of(F.col("text")).alias("key"), "text").join(small_side(met.select("key"), MOST_KEYS), "key", "left_semi")
    held = stored(texts.groupBy("key").agg(F.first("text").alias("text")).mapInArrow(_listed, "key string, size long, runs array<long>"))
    # A band's head is the member that meets most others in all of its bands: the text that copies were made of, if it is there.
    heads = members.join(met, "key").groupBy("band").agg(F.max(F.struct("met", "key", "size")).alias("head"))
    close = F.least(F.col("size"), F.col("head.size")) >= SIMILAR * F.greatest(F.col("size"), F.col("head.size"))
    headed = members.join(heads, "band").filter((F.col("key") != F.col("head.key")) & close).groupBy("key").agg(F.max("head").alias("head"))
    pairs = stored(headed.select(F.col("head.key").alias("a"), F.col("key").alias("b")))
    roots = components(verified(pairs, held, "key"))
    # Classes of bands that hold several components are open.
    placed = members.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    mixed = placed.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("band")
    open_ = placed.join(mixed, "band", "left_semi").select("key", "root").distinct()
    open_ = stored(open_.join(held, "key").select(F.monotonically_increasing_id().alias("id"), "root", "size", "runs"))
    found = verified(stored(candidates(open_)), open_, "id")
    name = lambda s: open_.select(F.col("id").alias(s), F.col("root").alias(f"root_{s}"))
    found = found.join(name("a"), "a").join(name("b"), "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    again = components(found).select(F.col("key").alias("root"), F.col("root").alias("above"))
    more = again.select(F.col("root").alias("key"), F.col("above").alias("root")).join(roots, "key", "left_anti")
    return roots.join(again, "root", "left").select("key", F.coalesce("above", "root").alias("root")).unionByName(more)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text -> doc_id, key, root, class_id for each row; root names the group, class_id is its smallest doc_id."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stored(rows.select("doc_id", key_of(F.col("text")).alias("key"), "text").mapInArrow(_signed, "doc_id long, key string, signature binary, size long"))
    roots = roots_of(signed, rows)
    keys = signed.groupBy("key").agg(F.min("doc_id").alias("first"))
    keys = stored(keys.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key")))
    groups = keys.groupBy("root").agg(F.min("first").alias("class_id"))
    named = keys.join(groups, "root").select("key", "root", "class_id")
    return signed.select("doc_id", "key").join(named, "key")


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs with one row of each group: the one of the smallest doc_id (of repeated ids, of the smallest key)."""
    found = stored(near_duplicates(docs))
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("root").agg(F.min("key").alias("kept"))
    named = found.join(kept, "root").select("doc_id", "key", (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("key") == F.col("kept"))).alias("stays"))
    # Few rows go, or are the same as one that stays: only these are named, so that texts needn't be shuffled.
    odd = stored(named.groupBy("doc_id", "key").agg(F.first("stays").alias("stays"), F.count(F.lit(1)).alias("n")).filter("NOT stays OR n > 1"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("row"), F.col("doc_id").cast("long").alias("id"), key_of(F.col("text")).alias("own"))
    same = lambda side: F.col("id").eqNullSafe(side["doc_id"]) & (F.col("own") == side["key"])
    gone, twice = small_side(odd, MOST_KEYS), odd.filter("stays")
    alone = rows.join(gone, same(gone), "left_anti")
    again = rows.join(small_side(twice, MOST_KEYS), same(twice), "left_semi").dropDuplicates(["id", "own"])
    return alone.unionByName(again).select("row.*")


def op9(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = near_duplicates(docs)
    return found.select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))
