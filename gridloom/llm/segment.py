"""SentencePiece encoding by sampled segmentations without replacement, and decoding.

The vocabulary is a SentencePiece model's. Its segmentations form a lattice over
each text, in which a piece has a probability by its rank (Zipf's law over the
order of merges; single symbols rank last), and a symbol outside the vocabulary
is spelled in bytes. Perturbed A* search emits the ``samples`` segmentations of
highest Gumbel-perturbed log-probability, which is a sample without replacement:
the best one is walked down by the lattice's own conditional probabilities; each
step leaves the edges not taken as an open node, whose best completion has a
Gumbel value truncated at its parent's; the open node of the highest value is
the next to be walked. As the sums over completions are exact, no node is opened
in vain. The first value left open is the threshold of the inclusion
probability 1 - exp(-exp(log p - threshold)), by which sums over samples can be
weighed (1 if there is nothing left).

Random numbers are seeded by doc_id alone and sums run over one text or one
node, so results don't depend on partitions or batches to the last bit, and rows
with equal doc_id and text get equal samples. No piece crosses a space that
follows another symbol, so lattices are built for the stretches between, in array
operations for those of many texts at once. A node stands for the rest of a
stretch, so stretches of equal ends share nodes; they go by 64-bit hashes, and
are kept while memory is bounded.

A null text counts as empty; an empty text has one segmentation, without pieces.
A null doc_id seeds like -1. Whole texts are encoded and ``decode`` restores them
exactly. Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterable, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches
from .symbols import BASE, SALT, hashed, names_of, parts_of, powers, release, spread, sums_of, symbols_of

SAMPLES = 2
MODEL = "piece_bpe_32k.model"
#: A stretch that has its own lattice; chunks_of() finds them in whole arrays.
_CHUNK = re.compile(r" +[^ \n]*|\n|[^ \n]+")
#: Edges kept before lattices are forgotten, about 60 MB with their nodes and names.
_MOST_EDGES = 1_000_000
#: Symbols, and but for single stretches more, that are named at once.
_SYMBOLS = 1 << 18
_STEP = np.uint64(BASE)
_M1, _M2, _S11, _S45 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(11), np.uint64(45)


class Vocabulary:
    """Pieces with their probabilities; spaces are written as spaces."""

    def __init__(self, pieces: Sequence[tuple[str, bool]]):
        """pieces in the order of ids: (text, whether it is a byte)."""
        self.bytes_: list[bytes] = []
        self.byte_ids = [0] * 256
        ranks: list[tuple[str, int]] = []
        for i, (piece, is_byte) in enumerate(pieces):
            if is_byte:
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_.append(bytes([int(piece[3:5], 16)]))
            else:
                text = piece.replace("▁", " ")
                self.bytes_.append(text.encode())
                if text and "\n" not in text:
                    ranks.append((text, i))
        total = sum(1 / (r + 10) for r in range(len(ranks) + 256))
        self.pieces = {text: (1 / (r + 10) / total, i) for r, (text, i) in enumerate(ranks)}
        self.byte_share = 1 / (len(ranks) + 266) / total
        self.longest = max(map(len, self.pieces), default=1)
        # Pieces by name, for whole arrays of them.
        texts = list(self.pieces)
        sums, ends = sums_of(symbols_of("".join(texts))), np.cumsum([0, *map(len, texts)])
        self.names = (sums[ends[1:]] - sums[ends[:-1]]) * powers(len(sums))[1][ends[:-1]]
        self.weights = np.log([self.pieces[t][0] for t in texts])
        self.ids = np.array([self.pieces[t][1] for t in texts], np.int32)
        self._place()

    def _place(self) -> None:
        """Tables from a name's bits to its number: what is pushed out of one has its place in the next."""
        self.singles = np.zeros(0x110000, bool)
        self.singles[[ord(t) for t in self.pieces if len(t) == 1]] = True
        self.tables: list[np.ndarray] = []
        left = np.arange(len(self.names), dtype=np.int32)
        while len(left) or not self.tables:
            table = np.full(1 << 18, -1, np.int32)
            at = self._slots(self.names[left], len(self.tables))
            table[at] = left
            self.tables.append(table)
            left = left[table[at] != left]
        self.written = pa.array(self.bytes_, pa.large_binary())

    @staticmethod
    def _slots(names: np.ndarray, turn: int) -> np.ndarray:
        return (names * np.uint64(pow(BASE, turn + 1, 1 << 64)) >> np.uint64(46)).astype(np.int64)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("singles", "tables", "written")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._place()

    def find(self, names: np.ndarray) -> np.ndarray:
        """The numbers of pieces by name, -1 for names that none has."""
        out = np.full(len(names), -1, np.int64)
        for turn, table in enumerate(self.tables):
            at = table[self._slots(names, turn)]
            np.copyto(out, at, where=(at >= 0) & (self.names[at] == names))
        return out

    def spelled(self, pieces: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of edges' pieces, ends among them); a symbol outside the vocabulary (-1 less its code) becomes its bytes. ends: of stretches of edges."""
        strange = np.flatnonzero(pieces < 0)
        if not len(strange):
            return pieces, ends
        bytes_ = [chr(-1 - x).encode() for x in pieces[strange].tolist()]
        many = np.ones(len(pieces), np.int64)
        many[strange] = [len(x) for x in bytes_]
        behind = np.concatenate([[0], np.cumsum(many)])
        out = np.repeat(pieces, many)
        out[spread(behind[strange], behind[strange + 1])[0]] = np.array(self.byte_ids, np.int32)[np.frombuffer(b"".join(bytes_), np.uint8)]
        return out, behind[ends]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        special = {i for i in range(sp.get_piece_size()) if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
        return cls([("" if i in special else sp.id_to_piece(i), sp.is_byte(i)) for i in range(sp.get_piece_size())])

    def decode(self, ids: Iterable[int]) -> str:
        """The text of a segmentation: the leading space that encoding adds is taken off."""
        return b"".join(map(self.bytes_.__getitem__, ids)).decode("utf-8", "replace")[1:]

    def spells(self, ids: np.ndarray, ends: np.ndarray, texts: Iterable[str]) -> list[bool]:
        """Whether each of these segmentations, one after another, has the bytes of its text behind the added space."""
        written = self.written.take(pa.array(ids))
        _, offsets, data = written.buffers()
        at = np.frombuffer(offsets, np.int64)[ends].tolist() if len(ids) else [0] * len(ends)
        data = memoryview(data) if data else b""
        return [bytes(data[a:b]) == ((" " + t).encode() if t else b"") for a, b, t in zip([0, *at], at, texts)]


def chunks_of(texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of stretches of each text, symbols, where stretches start among them), each text behind a space."""
    sizes = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
    symbols = symbols_of("".join([" " + t for t in texts if t]))
    line, space = symbols == 10, symbols == 32
    heads = line | space
    heads[1:] &= line[1:] | ~space[:-1]
    heads[1:] |= line[:-1]
    ends = np.cumsum(sizes)
    heads[(ends - sizes)[sizes > 0]] = True
    starts = np.flatnonzero(heads)
    return np.diff(np.searchsorted(starts, ends), prepend=0), symbols, starts


class Lattices:
    """Nodes and edges of the lattices of chunks, in flat arrays. A node's edges are neighbours."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.nodes = self.edges = 0
        self._full: tuple[int, int] | None = None  # nodes and edges that are kept, once there are enough
        self._names, self._numbers = np.empty(0, np.uint64), np.empty(0, np.int64)  # of kept nodes, by name
        # Of stretches met before: by some bits of the name the first node, if no other has these bits.
        self._table, self.name = np.full(1 << 19, -1, np.int32), np.empty(0, np.uint64)
        self.first = np.zeros(1, np.int64)  # by node: its first edge
        self.total = np.empty(0)  # by node: log-sum over all ways to the end
        # By edge: share of the node's edges up to this one; log of its share; next node (-1: end); piece.
        self.upto, self.log_p = np.empty(0), np.empty(0)
        self.target, self.piece = np.empty(0, np.int32), np.empty(0, np.int32)

    def open(self, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The first nodes of the lattices of these stretches of symbols; the arrays hold until the next call.

        What was met first, and so most of what is frequent, is kept; beyond
        _MOST_EDGES lattices last for one call.
        """
        if self._full:
            self.nodes, self.edges = self._full
        elif self.edges > _MOST_EDGES:
            self._full = self.nodes, self.edges
        ends = np.append(starts[1:], len(symbols))
        names, at = np.empty(len(starts), np.uint64), 0
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + _SYMBOLS, side="right")))
            a, b = int(starts[at]), int(ends[to - 1])
            names[at:to] = names_of(sums_of(symbols[a:b]), starts[at:to] - a, ends[at:to] - a)
            at = to
        slots = (names * _STEP >> _S45).astype(np.int64)
        found = self._table[slots].astype(np.int64)
        if self.nodes:
            found[self.name[found] != names] = -1
        left = np.flatnonzero(found < 0)
        if len(left):
            every, where, which = np.unique(names[left], return_index=True, return_inverse=True)
            own = self._kept(every)
            new = np.flatnonzero(own < 0)
            if len(new):
                head, end = starts[left[where[new]]], ends[left[where[new]]]
                own[new] = self._add(symbols[spread(head, end)[0]], end - head)
            found[left] = own[which]
            lasting = left if not self._full else left[found[left] < self._full[0]]
            self._table[slots[lasting]] = found[lasting]
        return found

    def _kept(self, names: np.ndarray) -> np.ndarray:
        """The numbers of kept nodes by name, -1 for names that none has; names: ascending."""
        if not len(self._names):
            return np.full(len(names), -1, np.int64)
        at = np.minimum(np.searchsorted(self._names, names), len(self._names) - 1)
        return np.where(self._names[at] == names, self._numbers[at], -1)

    def _room(self, nodes: int, edges: int) -> None:
        for name, n in (("first", nodes + 1), ("name", nodes), ("total", nodes), ("upto", edges), ("log_p", edges), ("target", edges), ("piece", edges)):
            old = getattr(self, name)
            if len(old) < n:
                more = np.empty(n + n // 2, old.dtype)
                more[: len(old)] = old
                setattr(self, name, more)

    def _add(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The first nodes of new stretches, one after another, made with all nodes behind them.

        A node's sum over all ways to the end needs those of shorter ends only,
        so nodes are numbered and gone through by length.
        """
        v, base = self.v, self.nodes
        ends = np.cumsum(sizes)
        place = np.arange(len(symbols))
        behind = np.repeat(ends, sizes)
        length = behind - place
        sums, down = sums_of(symbols), powers(len(symbols))[1]
        names, where, which = np.unique((sums[behind] - sums[:-1]) * down[: len(symbols)], return_index=True, return_inverse=True)
        number = self._kept(names)
        new = np.flatnonzero(number < 0)
        new = new[np.argsort(length[where[new]], kind="stable")]
        number[new] = base + np.arange(len(new))
        numbers = number[which]
        if not self._full:
            by_name = np.sort(new)
            at = np.searchsorted(self._names, names[by_name])
            self._names = np.insert(self._names, at, names[by_name])
            self._numbers = np.insert(self._numbers, at, number[by_name])
        of_new = names[new]
        place, length = where[new], length[where[new]]
        # All stretches that a piece may cover, long ones first.
        many = np.minimum(length, v.longest)
        row = np.repeat(np.arange(len(new)), many)
        ahead = np.cumsum(many)[row] - np.arange(len(row))
        begin = place[row]
        found = v.find((sums[begin + ahead] - sums[begin]) * down[begin])
        hit = np.flatnonzero(found >= 0)
        row, ahead, found = row[hit], ahead[hit], found[hit]
        weight, piece = v.weights[found], v.ids[found]
        strange = np.flatnonzero(~v.singles[symbols[place]])
        if len(strange):
            code = symbols[place[strange]].astype(np.int64)
            spelled = 1 + (code >= 0x80) + (code >= 0x800).astype(np.int64) + (code >= 0x10000)
            row, ahead = np.concatenate([row, strange]), np.concatenate([ahead, np.ones(len(strange), np.int64)])
            weight, piece = np.concatenate([weight, spelled * math.log(v.byte_share)]), np.concatenate([piece, -1 - code])
            order = np.argsort(row, kind="stable")
            row, ahead, weight, piece = row[order], ahead[order], weight[order], piece[order]
        n, start = len(row), self.edges
        self._room(base + len(new), start + n)
        self.name[base : base + len(new)] = of_new
        first = np.searchsorted(row, np.arange(len(new) + 1))
        target = np.where(ahead == length[row], -1, numbers[np.minimum(place[row] + ahead, len(symbols) - 1)])
        total, log_p = self.total, self.log_p[start : start + n]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(length)) + 1, [len(new)]]).tolist() if len(new) else [0]
        for a, b in zip(cuts, cuts[1:]):
            e, f = first[a], first[b]
            reached = weight[e:f] + np.where(target[e:f] < 0, 0.0, total[target[e:f]])
            heads, edges = first[a:b] - e, np.diff(first[a : b + 1])
            most = np.maximum.reduceat(reached, heads)
            sum_ = most + np.log(np.add.reduceat(np.exp(reached - np.repeat(most, edges)), heads))
            total[base + a : base + b] = sum_
            log_p[e:f] = reached - np.repeat(sum_, edges)
        upto, edges = np.exp(log_p), np.diff(first)
        rows, k = np.flatnonzero(edges > 1), 1
        while len(rows):
            upto[first[rows] + k] += upto[first[rows] + k - 1]
            k += 1
            rows = rows[edges[rows] > k]
        upto[first[1:] - 1] = 2.0  # the last edge takes what is left
        self.upto[start : start + n], self.target[start : start + n], self.piece[start : start + n] = upto, target, piece
        self.first[base : base + len(new) + 1] = start + first
        self.nodes, self.edges = base + len(new), start + n
        return numbers[ends - sizes]

    def siblings(self, edge: int) -> range:
        """All edges of this edge's node."""
        node = int(np.searchsorted(self.first[: self.nodes + 1], edge, side="right")) - 1
        return range(int(self.first[node]), int(self.first[node + 1]))

    def walk(self, starts: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the start, edge) of each step from these nodes to their lattices' ends, in order.

        seeds: a number for each start, changed at each step.
        """
        taken, steps = [], np.zeros(len(starts), np.int64)
        at, now = np.arange(len(starts)), starts
        while len(at):
            draw, edge = _uniform(seeds), self.first[now]
            beyond = np.flatnonzero(self.upto[edge] <= draw)
            while len(beyond):
                edge[beyond] += 1
                beyond = beyond[self.upto[edge[beyond]] <= draw[beyond]]
            taken.append((at, edge))
            steps[at] += 1
            now = self.target[edge]
            going = np.flatnonzero(now >= 0)
            at, now, seeds = at[going], now[going], seeds[going] + _STEP
        begins = np.cumsum(steps) - steps
        out = np.empty(int(steps.sum()), np.int64)
        for k, (at, edge) in enumerate(taken):
            out[begins[at] + k] = edge
        return np.repeat(np.arange(len(starts)), steps), out


def _uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) by hash."""
    return ((hashed(x) >> _S11).astype(float) + 0.5) * 2.0**-53


def _truncated(mass: np.ndarray, bound: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Gumbel values located at mass and bounded; none where there is no mass."""
    with np.errstate(divide="ignore", invalid="ignore"):
        out = mass - np.log(np.exp(mass - bound) - np.log(_uniform(seeds)))
    return np.where(np.isfinite(mass), np.minimum(out, bound), -np.inf)


class _Paths:
    """One segmentation of each of some texts, with the nodes each left open after its place ``first``."""

    def __init__(self, texts, text, chunk, edge, first, value, seeds, lattices):
        """text: for each step its place in texts (ascending); chunk, edge: of each step; seeds: by text."""
        self.texts, self.chunk, self.edge, self.value = texts, chunk, edge, value
        self.ends = np.searchsorted(text, np.arange(len(texts)), side="right")
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        log_p = lattices.log_p[edge]
        self.before, self.log_p = np.zeros(len(edge)), np.zeros(len(texts))
        for i, (a, b) in enumerate(zip(self.starts.tolist(), self.ends.tolist(), strict=True)):
            if b > a:  # summed text by text, so that batches don't matter
                sums = np.cumsum(log_p[a:b])
                self.before[a + 1 : b], self.log_p[i] = sums[:-1], sums[-1]
        self.excluded: dict[int, list[int]] = {}
        with np.errstate(divide="ignore"):
            mass = self.before + np.log(-np.expm1(np.minimum(log_p, 0.0)))
        place = np.arange(len(edge)) - self.starts[text]
        self.open = _truncated(mass, value[text], seeds[text] + place.astype(np.uint64) * SALT)
        self.open[place < first[text]] = -np.inf
        self.best = np.full(len(texts), -np.inf)
        self.at = self.starts.copy()
        some = np.flatnonzero(self.ends > self.starts)
        if len(some):
            self.best[some] = np.maximum.reduceat(self.open, self.starts[some])
            hit = np.flatnonzero(self.open == self.best[text])
            self.at[text[hit[::-1]]] = hit[::-1]  # the first of equals

    def reopen(self, i: int, at: int, open_: float) -> None:
        """Another value for the open node at a step of text i."""
        self.open[at] = open_
        part = self.open[self.starts[i] : self.ends[i]]
        k = int(np.argmax(part))
        self.best[i], self.at[i] = part[k], self.starts[i] + k


def sample_flat(lattices: Lattices, texts: Sequence[str], keys: Sequence[int], samples: int = SAMPLES) -> tuple[np.ndarray, np.ndarray, list[tuple[int, float, float]]]:
    """Of each text up to ``samples`` different segmentations, best value first: all piece ids, where each ends, (place of the text, log-probability, inclusion probability)."""
    sizes, symbols, heads = chunks_of(texts)
    starts = lattices.open(symbols, heads)
    del symbols, heads
    begins = np.cumsum(sizes) - sizes
    keys_ = hashed(np.array([k & 0xFFFFFFFFFFFFFFFF for k in keys], np.uint64) + SALT)
    seeds = lambda turn: hashed(keys_ + np.uint64(turn * int(_M2) % (1 << 64)))
    owner = np.repeat(np.arange(len(texts)), sizes)
    number = np.arange(len(owner)) - begins[owner]

    def chunk_seeds(rows: np.ndarray, turn: int) -> np.ndarray:
        return hashed(seeds(turn)[owner[rows]] ^ (number[rows].astype(np.uint64) * _M1 + np.uint64(1)))

    every = np.arange(len(owner))
    chunk, edge = lattices.walk(starts, chunk_seeds(every, 1))
    value = -np.log(-np.log(_uniform(seeds(0))))
    none = np.zeros(len(texts), np.int64)
    paths = [_Paths(np.arange(len(texts)), owner[chunk], chunk, edge, none, value, seeds(2), lattices)]
    where = [[(0, i)] for i in range(len(texts))]  # of each text's segmentations: which paths, which place in them
    last = value.copy()
    for turn in range(1, samples + 1):
        # Each text's highest open node over its segmentations so far.
        best = [max((paths[p].best[i], -p, i) for p, i in w) for w in where]
        last = np.array([x[0] for x in best])
        going = np.flatnonzero(np.isfinite(last) & (np.array([len(w) for w in where]) == turn))
        if turn == samples or not len(going):
            break
        heads, firsts, inner, tails = [], [], [], []
        takens = []
        for text in going.tolist():
            _, p, i = best[text]
            at = int(paths[-p].at[i])
            takens.append(paths[-p].excluded.setdefault(at, [int(paths[-p].edge[at])]))
        taken_n = np.array([len(x) for x in takens], np.uint64)
        draws = _uniform(seeds(4 * turn)[going] + taken_n).tolist()
        masses = np.full(len(going), -np.inf)
        for n, (text, taken) in enumerate(zip(going.tolist(), takens, strict=True)):
            _, p, i = best[text]
            path = paths[-p]
            at = int(path.at[i])
            left = [e for e in lattices.siblings(taken[0]) if e not in taken]
            shares = list(accumulate(np.exp(lattices.log_p[left]).tolist()))
            k = min(len(left) - 1, bisect.bisect_right(shares, draws[n] * shares[-1]))
            taken.append(left[k])
            # What is still open there, below the value just used.
            rest = shares[-1] - math.exp(lattices.log_p[left[k]]) if len(left) > 1 else 0.0
            if rest > 0:
                masses[n] = path.before[at] + math.log(rest)
            place = at - int(path.starts[i])
            heads.append((path.chunk[path.starts[i] : at + 1], np.append(path.edge[path.starts[i] : at], left[k])))
            firsts.append(place + 1)
            inner.append(int(lattices.target[left[k]]))
            tails.append(int(path.chunk[at]) + 1)
        again = _truncated(masses, last[going], seeds(4 * turn + 1)[going] + taken_n + np.uint64(1))
        for text, value in zip(going.tolist(), again.tolist(), strict=True):
            _, p, i = best[text]
            paths[-p].reopen(i, int(paths[-p].at[i]), value)
        # The rest of the chunk that holds the node, then the later chunks anew.
        ends = begins[going] + sizes[going]
        later = np.concatenate([np.arange(a, b) for a, b in zip(tails, ends.tolist(), strict=True)]).astype(np.int64)
        inside = np.flatnonzero(np.array(inner) >= 0)
        own = np.array(tails, np.int64) - 1
        from_ = np.concatenate([np.array(inner, np.int64)[inside], starts[later]])
        rows = np.concatenate([own[inside], later])
        order = np.lexsort((np.arange(len(rows)), rows))
        step, edge = lattices.walk(from_[order], chunk_seeds(rows[order], 4 * turn + 2))
        chunk = rows[order][step]
        cuts = np.searchsorted(chunk, np.stack([own, ends]))
        all_chunks = [x for (c, _), a, b in zip(heads, *cuts.tolist(), strict=True) for x in (c, chunk[a:b])]
        all_edges = [x for (_, e), a, b in zip(heads, *cuts.tolist(), strict=True) for x in (e, edge[a:b])]
        counts = np.array([len(c) + b - a for (c, _), a, b in zip(heads, *cuts.tolist(), strict=True)])
        text = np.repeat(np.arange(len(going)), counts)
        paths.append(_Paths(going, text, np.concatenate(all_chunks), np.concatenate(all_edges), np.array(firsts), last[going], seeds(4 * turn + 3)[going], lattices))
        for i, text in enumerate(going.tolist()):
            where[text].append((len(paths) - 1, i))
    rows, edges = [], []
    for text, w in enumerate(where):
        threshold = last[text]
        for p, i in w:
            path = paths[p]
            log_p = float(path.log_p[i])
            included = 1.0 if not math.isfinite(threshold) else -math.expm1(-math.exp(min(700.0, log_p - threshold)))
            rows.append((text, log_p, included))
            edges.append(path.edge[path.starts[i] : path.ends[i]])
    ends = np.cumsum([len(x) for x in edges], dtype=np.int64)
    pieces = lattices.piece[np.concatenate([np.empty(0, np.int64), *edges])]
    return *lattices.v.spelled(pieces, ends), rows


def sample_batch(lattices: Lattices, texts: Sequence[str], keys: Sequence[int], samples: int = SAMPLES) -> list[list[tuple[np.ndarray, float, float]]]:
    """For each text its segmentations: (piece ids, log-probability, inclusion probability)."""
    ids, ends, rows = sample_flat(lattices, texts, keys, samples)
    out: list[list[tuple[np.ndarray, float, float]]] = [[] for _ in texts]
    for a, b, (text, log_p, included) in zip([0, *ends.tolist()], ends.tolist(), rows):
        out[text].append((ids[a:b], log_p, included))
    return out


def sample(lattices: Lattices, text: str, key: int, samples: int = SAMPLES) -> list[tuple[np.ndarray, float, float]]:
    """The samples of one text."""
    return sample_batch(lattices, [text], [key], samples)[0]


def _encoded(vocabulary: Vocabulary, samples: int):
    fields = [("doc_id", pa.int64()), ("sample", pa.int32()), ("n_tokens", pa.int64()), ("log_prob", pa.float64()), ("inclusion", pa.float64()), ("round_trip", pa.bool_()), ("ids", pa.list_(pa.int32()))]

    def run(batches):
        lattices = Lattices(vocabulary)
        for b in batches:
            for part in parts_of(b, 1):
                doc_ids, texts = part.column(0).to_pylist(), [x or "" for x in part.column(1).to_pylist()]
                ids, ends, rows = sample_flat(lattices, texts, [-1 if x is None else x for x in doc_ids], samples)
                text, log_p, included = zip(*rows, strict=True)
                ends = np.concatenate([[0], ends])
                places = np.array(text)
                first = np.flatnonzero(np.diff(places, prepend=-1))
                numbers = 1 + np.arange(len(places)) - np.repeat(first, np.diff(np.append(first, len(places))))
                whole = vocabulary.spells(ids, ends[1:], (texts[i] for i in text))
                columns = [pa.array(c, t) for c, (_, t) in zip(([doc_ids[i] for i in text], numbers, np.diff(ends), log_p, included, whole), fields[:-1], strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32, copy=False)))
                yield pa.RecordBatch.from_arrays([*columns, lists], [n for n, _ in fields])
        del lattices
        release()

    return run


def model_path() -> str:
    """Where the public tokenizers are installed; the path is a parameter of encode()."""
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def encode(docs: DataFrame, path: str | None = None, samples: int = SAMPLES) -> DataFrame:
    """doc_id, text -> a row for each sampled segmentation: doc_id, sample (from 1), n_tokens, log_prob, inclusion, round_trip, ids.

    The vocabulary is read on the driver and travels with the tasks (its size is
    the model's). No shuffle.
    """
    small_batches(docs.sparkSession)
    vocabulary = Vocabulary.load(path or model_path())
    schema = "doc_id long, sample int, n_tokens long, log_prob double, inclusion double, round_trip boolean, ids array<int>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_encoded(vocabulary, samples), schema)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """encoded with a column text, restored from ids; a null list gives a null text."""
    vocabulary = Vocabulary.load(path or model_path())
    rest = [c for c in encoded.columns if c != "text"]
    at = rest.index("ids")

    def run(batches):
        for b in batches:
            texts = [None if x is None else vocabulary.decode(x) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*rest, "text"])

    kept = encoded.select(*rest)
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("text", T.StringType())]))


def op1(spark, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
