"""Toxicity by nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes.

Fitted on at most SAMPLE labelled documents (the smallest by a hash of doc_id,
none of which is held out). All words of texts and examples weigh, and inverse
document frequencies count all documents. The words and first letters that
stand far more often in documents labelled toxic weigh BOOST times as much, all
of them. The words of the examples are the index, in blocks of
neighbouring examples with each term's largest weight. What a query shares with
the examples by rarer terms is summed over their postings. For the terms that
most examples have, the block's largest weights say how much a block can still
reach, and only blocks that can hold one of the K nearest are multiplied out,
for some queries at once. That is done in single precision with a margin; what
is left is summed again in double precision, so the K nearest are exact and
don't depend on what else is in a batch. Frequencies are learned for the words
of the examples, all of them; a word that no example has can't meet one, and
counts in a text's norm as a word of one document, whichever it is. The votes
are weighted by nearness, and a
monotone curve fitted on the examples themselves turns the vote into a
probability. An example never votes for its own text, neither here nor there:
for all other texts, equal or not, the score is a function of the text alone.
Words go by 64-bit hashes.

A text without any word of an example gets the share of toxic examples among
those without words. A null text counts as empty. Labels that are null are no
labels; of several labels of a document the largest holds, and of several texts
with its doc_id the smallest is the example. Without labels all scores are 0.
Every row gives one row. Extra columns are ignored by ``score`` and kept by
``without_toxic``.
"""

from __future__ import annotations

import bisect
import functools
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, small_batches, stored
from .symbols import names_of, parts_of, release, spread, sums_of, symbols_of

SAMPLE, K, BLOCK = 20_000, 25, 64
#: Terms of an example in so many or more are multiplied block by block, at most DENSE of them. Queries at once, and texts and bytes of which they are grouped. Margin of single precision.
OFTEN, DENSE, GROUP, MARGIN = 50, 512, 64, 2e-5
TEXTS, BYTES = 1000, 3_000_000
#: Postings of terms with fewer are gathered together.
FEW = 80
#: A term needs so many toxic examples, such a likelihood ratio, and such a share of toxic ones.
MIN_TOXIC, MIN_RATIO, MIN_SHARE = 3, 15.0, 0.5
THRESHOLD = 0.3
#: Weight of such a term; other words weigh 1.
BOOST = 100.0
_TOP = np.uint64(48)
#: Names of a word's first letters are told from those of words by these.
PREFIXES = {n: np.uint64(n * 0xA0761D6478BD642F % (1 << 64)) for n in (4, 5, 6, 8)}


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


@functools.cache
def _letters() -> np.ndarray:
    """By symbol, whether it is part of a word: letters and signs like them, no digits."""
    out = np.zeros(0x110000, bool)
    out[[i for i in range(0x33480) if (c := chr(i)).isalnum() and not c.isdecimal()]] = True
    return out


class Words:
    """The different words of each of some texts, as arrays: names, counts, and the names of their first letters."""

    def __init__(self, texts: list[str | None]):
        low = [(t or "").lower() for t in texts]
        symbols = symbols_of("\0".join([*low, ""]))
        edges = np.flatnonzero(np.diff(_letters()[symbols].astype(np.int8), prepend=0))
        starts, stops = edges[::2], edges[1::2]
        sums = sums_of(symbols)
        names = names_of(sums, starts, stops)
        ends = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in low]))
        order = np.empty(len(names), np.int64)
        for a, b in zip([0, *ends.tolist()], ends.tolist()):
            order[a:b] = names[a:b].argsort()
            order[a:b] += a
        names = names[order]
        new = np.ones(len(names), bool)
        new[1:] = names[1:] != names[:-1]
        new[ends[ends < len(names)]] = True
        at = np.flatnonzero(new)
        self.sizes = np.diff(np.searchsorted(at, ends), prepend=0)
        self.names, self.counts, first = names[at], np.diff(np.append(at, len(names))), order[at]
        self._starts, self._lengths, self._sums = starts[first], (stops - starts)[first], sums
        self.texts = np.repeat(np.arange(len(texts)), self.sizes)

    def prefixes(self):
        """For each length: (places among the words, names)."""
        for n, mark in PREFIXES.items():
            at = np.flatnonzero(self._lengths >= n)
            yield at, names_of(self._sums, self._starts[at], self._starts[at] + n) ^ mark


def _distinct(texts: np.ndarray, names: np.ndarray) -> np.ndarray:
    """One of each name in each text; texts ascending."""
    order = np.lexsort((names, texts))
    texts, names = texts[order], names[order]
    new = np.ones(len(names), bool)
    new[1:] = (texts[1:] != texts[:-1]) | (names[1:] != names[:-1])
    return names[new]


def _tallied(pieces: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """(names, numbers ...) added up by name."""
    names = np.concatenate([x[0] for x in pieces])
    every, where = np.unique(names, return_inverse=True)
    return every, *(np.bincount(where, np.concatenate([x[i] for x in pieces]), len(every)).astype(np.int64) for i in range(1, len(pieces[0])))


def _counting(found, fields: list[str]):
    """Batches of texts -> names with numbers of texts in this partition; found: a batch's parts -> (names, numbers ...)."""

    def run(batches):
        pieces, many = [], 0

        def flushed():
            rows = _tallied(pieces)
            for at in range(0, len(rows[0]), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[at : at + 100_000].view(np.int64)) for x in rows], fields)

        for b in batches:
            for part in parts_of(b, 0):
                piece = found(part)
                pieces.append(piece)
                many += len(piece[0])
                if many > 1_500_000:
                    pieces = [_tallied(pieces)]
                    many = len(pieces[0][0])
                    if many > 1_000_000:
                        yield from flushed()
                        pieces, many = [], 0
        if pieces:
            yield from flushed()
        pieces = []
        release()

    return run


def _labelled(part: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """text, label -> (names of words and first letters, toxic, clean)."""
    words = Words(part.column(0).to_pylist())
    label = part.column(1).to_numpy() > 0
    out = []
    for toxic in (True, False):
        mine = label[words.texts] == toxic
        names = [words.names[mine]]
        for at, x in words.prefixes():
            own = mine[at]
            names.append(_distinct(words.texts[at][own], x[own]))
        out.append(np.concatenate(names))
    ones, none = np.ones(len(out[0])), np.zeros(len(out[1]))
    return np.concatenate(out), np.concatenate([ones, none]), np.concatenate([1 - ones, none + 1])


def _ratio(toxic: int, clean: int, all_toxic: int, all_clean: int) -> float:
    """Log likelihood ratio of a term's counts against independence."""
    n = all_toxic + all_clean
    out = 0.0
    for got, row, column in ((toxic, toxic + clean, all_toxic), (clean, toxic + clean, all_clean), (all_toxic - toxic, n - toxic - clean, all_toxic), (all_clean - clean, n - toxic - clean, all_clean)):
        if got:
            out += got * math.log(got * n / (row * column))
    return 2 * out


def _names(words: Words, telling: np.ndarray) -> np.ndarray:
    """Of each text its words and telling first letters, once each. telling: ascending."""
    names = [words.names]
    for at, x in words.prefixes():
        own = _among(telling, x) >= 0
        names.append(_distinct(words.texts[at][own], x[own]))
    return np.concatenate(names)


def _met(telling: np.ndarray):
    """(name, n): in how many texts of this partition a word or one of the telling first letters stands."""

    def found(part: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        names = _names(Words(part.column(0).to_pylist()), telling)
        return names, np.ones(len(names))

    return _counting(found, ["name", "n"])


def _met_known(shared):
    """The same of known names only, counted in place. shared: broadcast (known names, telling ones), ascending."""

    def run(batches):
        known, telling = shared.value
        places, n = _Places(known), np.zeros(len(known), np.int64)
        for b in batches:
            for part in parts_of(b, 0):
                at = places.find(_names(Words(part.column(0).to_pylist()), telling))
                np.add.at(n, at[at >= 0], 1)
        some = np.flatnonzero(n)
        for at in range(0, len(some), 100_000):
            rows = some[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(known[rows].view(np.int64)), pa.array(n[rows])], ["name", "n"])
        del places, n, some
        release()

    return run


def _among(sorted_: np.ndarray, names: np.ndarray) -> np.ndarray:
    """The places of names in an ascending array, -1 for others."""
    if not len(sorted_):
        return np.full(len(names), -1, np.int64)
    if len(sorted_) < 1 << 14:
        # Most names aren't among few; their first bits tell.
        near = np.zeros(1 << 16, bool)
        near[sorted_ >> _TOP] = True
        out = np.full(len(names), -1, np.int64)
        some = np.flatnonzero(near[names >> _TOP])
        at = np.minimum(np.searchsorted(sorted_, names[some]), len(sorted_) - 1)
        out[some] = np.where(sorted_[at] == names[some], at, -1)
        return out
    return _Places(sorted_).find(names)


class _Places:
    """The places of names in an ascending array, found by their first bits."""

    def __init__(self, sorted_: np.ndarray):
        bits = max(1, len(sorted_).bit_length() - 1)
        self.shift, self.size = np.uint64(64 - bits), len(sorted_)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount((sorted_ >> self.shift).astype(np.int64), minlength=1 << bits))]).astype(np.int32)
        self.sorted = np.append(sorted_, np.uint64((1 << 64) - 1))  # an end that no name is beyond

    def find(self, names: np.ndarray) -> np.ndarray:
        """-1 for names that aren't there."""
        at = self.starts[names >> self.shift].astype(np.int64)
        below = np.flatnonzero(self.sorted[at] < names)
        while len(below):
            at[below] += 1
            below = below[self.sorted[at[below]] < names[below]]
        at[(self.sorted[at] != names) | (at == self.size)] = -1
        return at


class Vocabulary:
    """Numbers of terms: the telling ones, then the examples' other words by frequency, and one for any other word."""

    def __init__(self, telling: np.ndarray, names: np.ndarray, counts: np.ndarray, n: int):
        """telling: ascending; names, counts: of the examples' words and telling terms in all documents."""
        order = np.argsort(names)
        names, counts = names[order], counts[order]
        place = _among(names, telling)
        own = np.where(place >= 0, counts[np.maximum(place, 0)] if len(counts) else 0, 0)
        rest = _among(telling, names) < 0
        names, counts = names[rest], counts[rest]
        order = np.lexsort((names, -counts))
        names, counts = names[order], counts[order]
        self.telling = telling
        self.size = len(telling) + len(names)
        every = np.concatenate([telling, names])
        order = np.argsort(every)
        self.sorted = every[order]
        self.places = np.append(order, len(every)).astype(np.int32)  # the last for any other word
        df = np.concatenate([own, counts, [1]])
        self.idf = np.log((n + 1) / (df + 1)) + 1
        self.idf[: len(telling)] *= BOOST
        self._found: _Places | None = None

    def __getstate__(self):
        return self.__dict__ | {"_found": None}

    def forget(self) -> None:
        """Gives back what is made where texts are looked up."""
        self._found = None

    def vectors(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sizes, ids, counts) of all texts' terms, one text after another; unknown words have the last number, maybe repeated."""
        words = Words(texts)
        if self._found is None:
            self._found = _Places(self.sorted)
        ids = self.places[self._found.find(words.names)]
        owner, counts = [words.texts], [words.counts]
        ids = [ids]
        for place, names in words.prefixes():
            at = _among(self.telling, names)
            hit = np.flatnonzero(at >= 0)
            # Words with the same first letters count together.
            key, where = np.unique(words.texts[place[hit]] * len(self.telling) + at[hit], return_inverse=True)
            owner.append(key // max(1, len(self.telling)))
            ids.append(key % max(1, len(self.telling)))
            counts.append(np.bincount(where, words.counts[place[hit]], len(key)).astype(np.int64))
        owner, ids, counts = (np.concatenate(x) for x in (owner, ids, counts))
        order = np.argsort(owner, kind="stable")
        return np.bincount(owner, minlength=len(texts)), ids[order], counts[order]


def _in_blocks(lengths: np.ndarray, ids: np.ndarray, names: np.ndarray) -> np.ndarray:
    """The order of examples in which likes come together."""
    ends = np.cumsum(lengths)
    heads = [np.sort(ids[e - m : e])[:32].tolist() for e, m in zip(ends, lengths)]
    return np.array(sorted(range(len(lengths)), key=lambda i: (heads[i], names[i])), np.int64)


def _by_term(lengths: np.ndarray, ids: np.ndarray, order: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of entries of each term, their examples' places, the entries) by term and place."""
    place = np.empty(len(order), np.uint16 if len(order) <= 1 << 16 else np.int32)
    place[order] = np.arange(len(order))
    examples = np.repeat(place, lengths)
    entries = np.lexsort((examples, ids))
    return np.bincount(ids, minlength=terms), examples[entries], entries


def _pieces(sizes: np.ndarray):
    """(place of the first entry, terms of the entries) of neighbouring terms, about 300,000 entries at once."""
    ends = np.cumsum(sizes)
    first = at = 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(ends, at + 300_000)))
        yield at, np.repeat(np.arange(first, last, dtype=np.int32), sizes[first:last])
        first, at = last, int(ends[last - 1])


class BlockMaxIndex:
    """Unit vectors of examples by term, in blocks of neighbouring examples."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], labels, names, terms: int):
        lengths = np.array([len(x[0]) for x in vectors], np.int64)
        ids = np.concatenate([np.empty(0, np.int32), *(x[0].astype(np.int32) for x in vectors)])
        names = np.array(names, np.int64)
        order = _in_blocks(lengths, ids, names)
        sizes, examples, entries = _by_term(lengths, ids, order, terms)
        self._fill(sizes, examples, np.concatenate([np.empty(0), *(x[1] for x in vectors)])[entries], np.array(labels, float)[order], names[order])

    @classmethod
    def of(cls, sizes, examples, weights, labels, names) -> BlockMaxIndex:
        """The same from entries by term and place."""
        out = cls.__new__(cls)
        out._fill(sizes, examples, weights, labels.astype(float), names)
        return out

    def _fill(self, sizes, examples, weights, labels, names) -> None:
        n, terms = len(labels), len(sizes)
        self.labels, self.names = labels, names
        self.rank = np.argsort(np.argsort(self.names, kind="stable"), kind="stable")
        self.blocks = -(-n // BLOCK)
        dense = np.sort(np.argsort(-sizes, kind="stable")[:DENSE])
        self.dense = dense[sizes[dense] * OFTEN >= max(1, n)]
        self.column = np.full(terms, -1, np.int16)
        self.column[self.dense] = np.arange(len(self.dense))
        # Of dense terms all examples' weights; of others, by term, weights whose last bits are the place.
        self.table = np.zeros((len(self.dense), self.blocks * BLOCK), np.float32)
        self.starts = np.concatenate([[0], np.cumsum(np.where(self.column < 0, sizes, 0))])
        self.postings = np.empty(self.starts[-1])
        self.mask = np.int64((1 << max(1, n.bit_length())) - 1)
        # By example, where its terms are.
        self.ends = np.cumsum(np.bincount(examples, minlength=n))
        self.begins = np.concatenate([[0], self.ends[:-1]]) if n else self.ends
        self.ids, self.weights = np.empty(len(examples), np.int32), np.empty_like(weights)
        free, put = self.begins.copy(), 0
        for at, ids in _pieces(sizes):  # a copy of all at once would be as large as the index
            own, example, weight = self.column[ids], examples[at : at + len(ids)], weights[at : at + len(ids)]
            self.table[own[own >= 0], example[own >= 0]] = weight[own >= 0]
            rest = example[own < 0]
            self.postings.view(np.int64)[put : put + len(rest)] = weight[own < 0].astype(float).view(np.int64) & ~self.mask | rest
            put += len(rest)
            order = np.argsort(example, kind="stable")
            example = example[order]
            many = np.bincount(example, minlength=n)
            to = free[example] + np.arange(len(example)) - (np.cumsum(many) - many)[example]
            self.ids[to], self.weights[to] = ids[order], weight[order]
            free += many
        self.highest = self.table.reshape(len(self.dense), self.blocks, BLOCK).max(axis=2)
        self._spots = np.zeros(terms)

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, without=None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each (ids, weights): (places, cosines) of the k nearest, best first, ties to the smaller name; of all with a common term if fewer."""
        heads = np.zeros((len(queries), len(self.dense)), np.float32)
        for i, (ids, weights) in enumerate(queries):
            at = self.column[ids]
            heads[i, at[at >= 0]] = weights[at >= 0]
        ahead = heads @ self.highest
        out: list = [(np.empty(0, np.int64), np.empty(0))] * len(queries)
        if not self.blocks:
            return out
        order = np.argsort(ahead.argmax(axis=1), kind="stable")  # queries of the same blocks come together
        for at in range(0, len(order), GROUP):
            group = order[at : at + GROUP]
            sums = np.empty((len(group), self.blocks * BLOCK), np.float32)
            for row, i in enumerate(group):
                sums[row] = self._met(*queries[i])
            most = sums.reshape(len(group), self.blocks, BLOCK)
            while most.shape[2] > 4:  # halves of blocks against each other
                most = np.maximum(most[:, :, : most.shape[2] // 2], most[:, :, most.shape[2] // 2 :])
            reach = ahead[group] + most.max(axis=2) + MARGIN
            done = np.zeros(self.blocks, bool)
            done[np.argpartition(-reach, min(k // BLOCK, self.blocks - 1), axis=1)[:, : 1 + k // BLOCK]] = True
            self._complete(sums, heads[group], done)
            barred = [(row, without[i]) for row, i in enumerate(group) if without is not None and without[i] >= 0]
            for row, place in barred:
                sums[row, place] = 0
            seen = self._seen(sums, done)
            least = self._kth(seen, k)
            more = (reach >= least[:, None]).any(axis=0) & ~done
            if more.any():
                self._complete(sums, heads[group], more)
                done |= more
                for row, place in barred:
                    sums[row, place] = 0
                seen = self._seen(sums, done)
                least = self._kth(seen, k)
            least = np.maximum(least - np.float32(MARGIN), np.finfo(np.float32).tiny)
            place = (np.flatnonzero(done)[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            rows, at_ = np.nonzero(seen >= least[:, None])
            found = np.split(place[at_], np.searchsorted(rows, np.arange(1, len(group))))
            for i, x in zip(group, found, strict=True):
                out[i] = self._exact(*queries[i], x, k)
        return out

    def _complete(self, sums: np.ndarray, heads: np.ndarray, blocks: np.ndarray) -> None:
        """Adds what the dense terms give in these blocks, neighbouring blocks at once."""
        terms = np.flatnonzero(heads.any(axis=0))  # texts of one language come together, and have few of the others' terms
        heads = heads[:, terms]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], blocks.astype(np.int8), [0]]))) * BLOCK
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            for c in range(a, b, 32 * BLOCK):
                d = min(b, c + 32 * BLOCK)
                sums[:, c:d] += heads @ self.table[terms, c:d]

    def _met(self, ids: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What a query shares with each example by rarer terms."""
        starts = self.starts[ids]
        n = self.starts[ids + 1] - starts
        some = np.flatnonzero(n)
        some = some[np.argsort(n[some], kind="stable")]
        starts, n = starts[some], n[some]
        few = int(np.searchsorted(n, FEW))
        ends = starts + n
        met = np.concatenate([self.postings.take(spread(starts[:few], ends[:few])[0]), *(self.postings[a:b] for a, b in zip(starts[few:].tolist(), ends[few:].tolist()))])
        parts = np.repeat(weights[some], n)
        parts *= met
        out = np.zeros(self.blocks * BLOCK)
        np.add.at(out, met.view(np.int64) & self.mask, parts)
        return out

    @staticmethod
    def _seen(sums: np.ndarray, done: np.ndarray) -> np.ndarray:
        return sums.reshape(len(sums), -1, BLOCK)[:, done].reshape(len(sums), -1)

    @staticmethod
    def _kth(seen: np.ndarray, k: int) -> np.ndarray:
        return np.partition(seen, -k, axis=1)[:, -k] if seen.shape[1] >= k else np.zeros(len(seen), np.float32)

    def _exact(self, ids, weights, found, k):
        """The k best of these examples, their cosines summed in double precision."""
        if not len(found):
            return found, np.empty(0)
        self._spots[ids] = weights
        begins, ends = self.begins[found], self.ends[found]
        own = [slice(a, b) for a, b in zip(begins.tolist(), ends.tolist())]
        products = self._spots.take(np.concatenate([self.ids[x] for x in own], dtype=np.int64))
        products *= np.concatenate([self.weights[x] for x in own])
        cosines = np.round(np.add.reduceat(products, np.cumsum(ends - begins) - (ends - begins)), 9)
        self._spots[ids] = 0
        best = np.lexsort((self.rank[found], -cosines))[:k]
        best = best[cosines[best] > 0]
        return found[best], cosines[best]

    def nearest(self, ids: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        return self.search([(ids, weights)], k, [without])[0]


def _digest(text: str | None) -> int:
    return xxhash.xxh3_64_intdigest((text or "").encode()) - (1 << 63)


class Model:
    """The vocabulary with inverse document frequencies, and the examples by term; their index is made where it is used."""

    def __init__(self, words: Vocabulary, names, labels, digests, lengths, ids, counts, prior: float, empty: float):
        """ids, counts: the examples' terms, one after another; prior: share of toxic ones; empty: that of those without terms."""
        self.words, self.prior, self.empty = words, prior, empty
        full = np.flatnonzero(lengths)
        order = _in_blocks(lengths[full], ids, names[full])
        self.names, self.labels, self.digests = (x[full][order] for x in (names, labels, digests))
        self.sizes, examples, entries = _by_term(lengths[full], ids, order, words.size)
        self.packed = [(x.dtype, zlib.compress(x.tobytes(), 1)) for x in (examples, counts[entries].astype(np.uint16 if counts.max(initial=0) < 1 << 16 else np.int32))]
        self._index: BlockMaxIndex | None = None

    def __getstate__(self):
        return self.__dict__ | {"_index": None}

    @property
    def index(self) -> BlockMaxIndex:
        if self._index is None:
            examples, counts = (np.frombuffer(zlib.decompress(x), dtype) for dtype, x in self.packed)
            logs, norms = np.log(np.arange(1, 1 + counts.max(initial=1))) + 1, np.zeros(len(self.names))
            # The examples' weights are kept in single precision, their products with a query's are added in double.
            weights = np.empty(len(counts), np.float32)
            for at, ids in _pieces(self.sizes):
                w = logs[counts[at : at + len(ids)] - 1] * self.words.idf[ids]
                norms += np.bincount(examples[at : at + len(ids)], w * w, len(norms))
                weights[at : at + len(ids)] = w
            del counts
            norms = np.sqrt(norms)
            for at in range(0, len(weights), 300_000):
                weights[at : at + 300_000] /= norms[examples[at : at + 300_000]]
            self._index = BlockMaxIndex.of(self.sizes, examples, weights, self.labels, self.names)
            self._own = dict(zip(self.digests.tolist(), range(len(self.digests)), strict=True))
            del examples, weights
            release()
        return self._index

    def weighed(self, sizes, ids, counts):
        """(sizes, ids, weights) of unit vectors without the words that no example has. sizes: none is 0."""
        if not len(sizes):
            return sizes, ids, counts.astype(float)
        w = np.log(counts)
        w += 1
        w *= self.words.idf[ids]
        starts = np.cumsum(sizes) - sizes
        w /= np.repeat(np.sqrt(np.add.reduceat(w * w, starts)), sizes)
        own = ids < self.words.size
        return np.add.reduceat(own, starts, dtype=np.int64), ids[own], w[own]

    def votes(self, texts: list[str | None]) -> list[tuple[float, list[int]] | None]:
        """Of each text the vote of its nearest examples, but its own, and their names; none without a common word."""
        index = self.index
        rows = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
        found = [self.words.vectors(part.column(0).to_pylist()) for part in parts_of(rows, 0)]
        sizes, ids, counts = (np.concatenate([np.empty(0, np.int64), *(x[i] for x in found)]) for i in range(3))
        some = np.flatnonzero(sizes)
        sizes, ids, weights = self.weighed(sizes[some], ids, counts)
        ends = np.cumsum(sizes)
        queries = [(ids[a:b], weights[a:b]) for a, b in zip((ends - sizes).tolist(), ends.tolist())]
        found = index.search(queries, K, [self._own.get(_digest(texts[i]), -1) for i in some])
        out: list = [None] * len(texts)
        for i, (places, cosines) in zip(some, found, strict=True):
            if len(places):
                w = 1 / (1.02 - np.minimum(cosines, 1))
                out[i] = float(((w * index.labels[places]).sum() + self.prior) / (w.sum() + 1)), index.names[places[:3]].tolist()
        return out


def _drop(shared) -> None:
    """Gives the broadcast model and its index back; the next task reads it again from the executor's file.

    Idle workers live on, tasks are dealt to them in turn, and each would keep one, in the stages that follow too.
    """
    shared.value._index = None
    shared.value.words.forget()
    if getattr(shared, "_path", None) is not None:
        shared.__dict__.pop("_value", None)
    release()


def fitted_curve(votes: list[tuple[float, int]], prior: float) -> tuple[list[float], list[float]]:
    """Highest votes and shares of toxic ones of pooled neighbours: the best monotone fit. Each pool is shrunk by one vote at the prior."""
    pools: list[list[float]] = []
    for v, y in sorted(votes):
        pools.append([y, 1.0, v])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            y1, n1, _ = pools.pop()
            pools[-1][0] += y1
            pools[-1][1] += n1
            pools[-1][2] = v
    return [p[2] for p in pools], [(p[0] + prior) / (p[1] + 1) for p in pools]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """docs: doc_id, text; labels: doc_id, toxic -> (broadcast model, curve)."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("label"))
    # At most ``sample`` rows of two numbers: small enough to broadcast at any size of the input.
    chosen = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    texts = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    # Copies are one example: of equal texts the smallest doc_id speaks.
    texts = stored(texts.groupBy(F.md5(F.coalesce("text", F.lit(""))).alias("key")).agg(F.min(F.struct("doc_id", "label", "text")).alias("x")).select("x.*"))
    counts = {bool(r.label): r.n for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = counts.get(True, 0), counts.get(False, 0)
    found = texts.select("text", "label").mapInArrow(_counting(_labelled, ["name", "toxic", "clean"]), "name long, toxic long, clean long").groupBy("name").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    found = found.filter((F.col("toxic") >= MIN_TOXIC) & (F.col("toxic") >= MIN_SHARE * (F.col("toxic") + F.col("clean"))))
    # Of terms of equal counts the smaller name stays; the limit bounds what is collected.
    rows = zip(*(x.to_pylist() for x in found.select("name", "toxic", "clean").toArrow().columns))  # of the sample's terms
    telling = np.sort(np.array([name for name, t, c in rows if _ratio(t, c, toxic, clean) >= MIN_RATIO], np.int64).view(np.uint64))
    # For each name that an example has: how many of all documents.
    own = texts.select("text").mapInArrow(_met(telling), "name long, n long").select("name").distinct().toArrow()["name"].to_numpy().view(np.uint64)
    known = docs.sparkSession.sparkContext.broadcast((np.sort(own), telling))
    counted = docs.select("text").mapInArrow(_met_known(known), "name long, n long").groupBy("name").agg(F.sum("n").alias("n")).toArrow()
    words = Vocabulary(telling, counted["name"].to_numpy().view(np.uint64), counted["n"].to_numpy(), docs.count())
    known.unpersist()
    del own, counted
    vectors = texts.select("doc_id", "label", "text").mapInArrow(_example_vectors(words), "doc_id long, label int, digest long, ids array<int>, counts array<int>")
    found = vectors.orderBy("doc_id").toArrow().combine_chunks()  # at most ``sample`` rows
    names, labels_, digests = (found[c].to_numpy() for c in ("doc_id", "label", "digest"))
    ids, counts = (np.concatenate([np.empty(0, np.int32), *(x.values.to_numpy()[x.offsets[0].as_py() : x.offsets[-1].as_py()] for x in found[c].chunks)]) for c in ("ids", "counts"))
    lengths = np.concatenate([np.empty(0, np.int64), *(np.diff(x.offsets.to_numpy()) for x in found["ids"].chunks)]).astype(np.int64)
    none = Counter((labels_[lengths == 0] > 0).tolist())
    prior = toxic / max(1, toxic + clean)
    empty = (none[True] + prior) / (none[True] + none[False] + 1)
    shared = docs.sparkSession.sparkContext.broadcast(Model(words, names, labels_, digests, lengths, ids, counts, prior, empty))
    # Each task makes the index, so none is of a few texts.
    votes = texts.repartition(min(shuffle_partitions(docs.sparkSession), 1 + (toxic + clean) // 2000)).select("label", "text").mapInArrow(_voted(shared), "vote double, label int").collect()
    return shared, fitted_curve([(r.vote, r.label) for r in votes], prior)


def _example_vectors(words: Vocabulary):
    def run(batches):
        for b in batches:
            for part in parts_of(b, 2):
                texts = part.column(2).to_pylist()
                sizes, ids, counts = words.vectors(texts)
                ends = pa.array(np.cumsum([0, *sizes]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (ids, counts)]
                digests = pa.array([_digest(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), digests, *lists], ["doc_id", "label", "digest", "ids", "counts"])
        words.forget()
        release()

    return run


def _voted(shared):
    def run(batches):
        for b in batches:
            for part in parts_of(b, 1, TEXTS, BYTES):
                rows = [(v[0], y) for v, y in zip(shared.value.votes(part.column(1).to_pylist()), part.column(0).to_pylist(), strict=True) if v]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.int32())], ["vote", "label"])
        _drop(shared)

    return run


def _scored(fitted):
    """fitted: a broadcast model and its curve. Of equal texts in a task one is scored."""
    shared, (highs, shares) = fitted
    memo: dict = {}

    def value(vote):
        if vote is None or not highs:
            return shared.value.empty, []
        p = shares[min(bisect.bisect_left(highs, vote[0]), len(shares) - 1)]
        return min(1.0, max(0.0, 0.99 * p + 0.01 * vote[0])), vote[1]

    def run(batches):
        for b in batches:
            for part in parts_of(b, 1, TEXTS, BYTES):
                texts = part.column(1).to_pylist()
                keys = [xxhash.xxh3_128_digest((t or "").encode()) for t in texts]
                if len(memo) > 20_000:
                    memo.clear()
                new = {k: t for k, t in zip(keys, texts, strict=True) if k not in memo}
                memo.update(zip(new, map(value, shared.value.votes(list(new.values()))), strict=True))
                scores, near = zip(*(memo[k] for k in keys), strict=True) if keys else ((), ())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64()), pa.array(near, pa.list_(pa.int64()))], ["doc_id", "score", "evidence"])

    return run


def _then_dropped(run, shared):
    """Without the index at the end."""

    def all_(batches):
        yield from run(batches)
        _drop(shared)

    return all_


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, score, evidence (doc_ids of the nearest examples) for each row of docs."""
    fitted = fit(docs, labels, sample)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_then_dropped(_scored(fitted), fitted[0]), "doc_id long, score double, evidence array<long>")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs whose text scores below threshold, columns unchanged.

    The score is a function of the text alone, so rows are scored where they stand.
    """
    fitted = fit(docs, labels, sample)
    at = docs.columns.index("text")

    def kept(batches):
        scored = _scored(fitted)
        for b in batches:
            for part in parts_of(b, at, TEXTS, BYTES):
                rows = pa.RecordBatch.from_arrays([pa.nulls(part.num_rows, pa.int64()), part.column(at)], ["doc_id", "text"])
                scores = [x.column(1) for x in scored([rows])]
                yield part.filter(pa.compute.less(pa.chunked_array(scores, pa.float64()).combine_chunks(), threshold))

    return docs.mapInArrow(_then_dropped(kept, fitted[0]), docs.schema)


def op5(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = score(docs, labels).withColumn("held_out", held_out(F.col("doc_id")))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")
