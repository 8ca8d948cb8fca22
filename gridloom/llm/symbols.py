"""Stretches of many texts as 64-bit names, in array operations.

A stretch's name is a polynomial over hashes of its symbols: the difference of
running sums at its two ends, moved back to its place by the inverse power.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute

#: Texts, and but for single ones bytes, that are taken together.
TEXTS, BYTES = 200, 200_000
BASE = 0x9E3779B97F4A7C15
SALT = np.uint64(0xD1B54A32D192ED03)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = (np.uint64(x) for x in (30, 27, 31))


def hashed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S30)) * _M1
    x ^= x >> _S27
    x *= _M2
    x ^= x >> _S31
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least the first n powers of a base and of its inverse."""
    if len(powers.kept[0]) < n:
        up, down = (np.full(max(n, 1 << 19), x, np.uint64) for x in (BASE, pow(BASE, -1, 1 << 64)))
        up[:1] = down[:1] = 1
        powers.kept = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return powers.kept


powers.kept = (np.empty(0, np.uint64), np.empty(0, np.uint64))


def symbols_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def sums_of(symbols: np.ndarray) -> np.ndarray:
    """Running sums: before each symbol, and behind the last."""
    sums = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(hashed(symbols.astype(np.uint64) + SALT) * powers(len(symbols))[0][: len(symbols)], out=sums[1:])
    return sums


def names_of(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return (sums[ends] - sums[starts]) * powers(len(sums))[1][starts]


def spread(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, lengths): the ranges starts..ends one after another."""
    n = ends - starts
    total = int(n.sum())
    return np.arange(total) + np.repeat(starts - (np.cumsum(n) - n), n), n


def parts_of(b: pa.RecordBatch, column: int, texts: int = TEXTS, most: int = BYTES) -> Iterable[pa.RecordBatch]:
    """Slices of at most so many rows and, but for single texts, bytes of a text column."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(b.column(column)), 0).to_pylist()
    at = many = 0
    for i, n in enumerate(sizes):
        if i > at and (i - at == texts or many + n > most):
            yield b.slice(at, i - at)
            at, many = i, 0
        many += n
    if b.num_rows:
        yield b.slice(at)


def release() -> None:
    """Gives freed memory back to the system: a worker stays alive after its task, and what it holds counts for its executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
