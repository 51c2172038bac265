"""Words and shingles of many texts at once, as arrays of 64-bit hashes.

A word is a run of letters and digits of the lower-cased text (underscore is not
one of them). Work goes by slices of about ``SLICE`` characters, so memory
follows the slice, or one text if that is longer, and not the Arrow batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa

SLICE = 400_000
BATCH_ROWS = 256
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


@cache
def alnum_table() -> np.ndarray:
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


@cache
def letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads the bits of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.values = np.uint64(base), np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            steps = np.full(max(n, 2 * SLICE), self.base, np.uint64)
            steps[0] = 1
            self.values = np.multiply.accumulate(steps)
        return self.values[:n]


_UP, _DOWN = _Powers(_BASE), _Powers(pow(_BASE, -1, 1 << 64))


def small(batches: Iterable[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches a few at a time: a whole batch of texts as Python strings takes much memory."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def each(udf_input: Iterable[pa.Array], result: Callable[[list], pa.Array], rows: int = BATCH_ROWS) -> Iterator[pa.Array]:
    """``result`` of the texts of Arrow arrays, a few rows at a time, one array for each array."""
    for array in udf_input:
        parts = [result(array.slice(at, rows).to_pylist()) for at in range(0, len(array), rows)]
        yield pa.concat_arrays(parts) if parts else result([])


def unused(name: str, columns: Iterable[str]) -> str:
    """A column name like ``name`` that no column has, in any letter case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(texts: list[str | None], size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` that hold about ``size`` characters each."""
    lo, held = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > lo and held + n > size:
            yield lo, i
            lo, held = i, 0
        held += n
    if lo < len(texts):
        yield lo, len(texts)


def words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each text where its words start (n + 1 bounds)."""
    lowered = [(t or "").lower() for t in texts]
    points = code_points("\n".join(lowered) + "\n")
    inside = alnum_table()[points]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    begin, end = edges[::2], edges[1::2]
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * _UP.upto(len(points)), out=sums[1:])
    hashes = mix((sums[end] - sums[begin]) * _DOWN.upto(len(points))[begin])
    ends = np.cumsum([len(t) + 1 for t in lowered])
    return hashes, np.concatenate(([0], np.searchsorted(begin, ends)))


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``size`` words within a text, and bounds by text."""
    count = np.maximum(np.diff(bounds) - (size - 1), 0)
    out = np.concatenate(([0], np.cumsum(count)))
    if not out[-1]:
        return np.zeros(0, np.uint64), out
    last = len(hashes) - size + 1
    rolled = np.zeros(last, np.uint64)
    for j in range(size):
        rolled *= np.uint64(_BASE)
        rolled += hashes[j : j + last]
    keep = np.repeat(bounds[:-1] - out[:-1], count) + np.arange(out[-1])
    return mix(rolled[keep]), out


def text_shingles(
    hashes: np.ndarray, bounds: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """As ``shingles``, but a text of fewer words has one shingle of all its words."""
    long, edges = shingles(hashes, bounds, size)
    n = np.diff(bounds)
    short = np.flatnonzero((n > 0) & (n < size))
    if not len(short):
        return long, edges
    own = np.zeros(len(short), np.uint64)
    for i, t in enumerate(short.tolist()):
        own[i] = shingles(hashes[bounds[t] : bounds[t + 1]], np.array([0, n[t]]), int(n[t]))[0][0]
    count = np.diff(edges)
    count[short] = 1
    return np.insert(long, edges[short], own), np.concatenate(([0], np.cumsum(count)))
