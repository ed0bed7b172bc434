"""Whole Arrow batches of text as NumPy arrays: word borders, word hashes, shingles.

Works on the UTF-8 bytes of a batch, so a text costs no Python object per word. Both
word definitions in use are unions of whole byte classes: bytes from 0x80 up are always
word bytes, so no code point is ever cut.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
SLICE_ROWS = 4096
WIDTH = 5

_random = np.random.Generator(np.random.PCG64(20240601))
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
#: Odd multipliers for the words of a window, by place; windows are at most 64 words wide.
PLACE = _random.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _bytes_in(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: ``[^\x20\x09-\x0D]+``
NOT_SPACE = ~_bytes_in((0x20, 0x20), (0x09, 0x0D))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``
LETTER_DIGIT = ~_bytes_in((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Texts:
    """Some rows of a batch: their bytes, and where each row begins (``off``, one more than rows)."""

    def __init__(self, data: np.ndarray, off: np.ndarray, low: int, lower: bool):
        self.data, self.off, self.low = (_LOWER[data] if lower else data), off, low
        self.rows = len(off) - 1

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of maximal runs of ``inside`` bytes, and each row's first run (rows + 1)."""
        n = len(self.data)
        into = inside.copy()
        edge = self.off[:-1][self.off[:-1] < n]
        into[1:] &= ~inside[:-1]
        into[edge] = inside[edge]
        out = inside.copy()
        out[:-1] &= ~inside[1:]
        last = self.off[1:][self.off[1:] > 0] - 1
        out[last] = inside[last]
        starts = np.flatnonzero(into)
        return starts, np.flatnonzero(out) + 1, np.searchsorted(starts, self.off)

    def words(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.spans(table[self.data])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the bytes of each span; spans are sorted and do not overlap."""
        out = np.empty(len(starts), np.uint64)
        done = 0
        while done < len(starts):
            stop = max(done + 1, int(np.searchsorted(ends, starts[done] + SLICE_BYTES, "right")))
            first, last = starts[done], ends[stop - 1]
            size = int(last - first)
            up, down = _powers(size + 1)
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(_BYTE[self.data[first:last]] * up[:size], out=sums[1:])
            s, e = starts[done:stop] - first, ends[done:stop] - first
            out[done:stop] = (sums[e] - sums[s]) * down[s]
            done = stop
        return mix(out)


_kept: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    if _kept and len(_kept[0][0]) >= size:
        return _kept[0]
    length = max(size, SLICE_BYTES + 1)
    made = []
    for base in (_BASE, _BASE_INVERSE):
        powers = np.full(length, base, np.uint64)
        powers[0] = 1
        made.append(np.multiply.accumulate(powers))
    if length == SLICE_BYTES + 1:
        _kept[:] = [(made[0], made[1])]
    return made[0], made[1]


def slices(column: pa.Array, lower: bool = False) -> Iterator[Texts]:
    """The rows of a string column in order, about a megabyte and at most ``SLICE_ROWS`` at a time; NULL is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(off, off[low] + SLICE_BYTES, "right")) - 1)
        high = min(high, len(column), low + SLICE_ROWS)
        yield Texts(raw[off[low] : off[high]], off[low : high + 1] - off[low], low, lower)
        low = high


def windows(h: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``width`` consecutive words within a row, and the word each starts at."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    total = np.zeros(n, np.uint64)
    for j in range(width):
        total += h[j : j + n] * PLACE[j]
    row_end = np.repeat(first[1:], np.diff(first))[:n]
    at = np.flatnonzero(np.arange(n) + width <= row_end)
    return mix(total[at]), at


def shingles(h: np.ndarray, first: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the shingles of each row, repeats included; a row of fewer words has one for all its words."""
    found, at = windows(h, first, width)
    rows = np.searchsorted(first, at, "right") - 1
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        total = counts[short].astype(np.uint64)
        for j in range(width - 1):
            has = counts[short] > j
            total[has] += h[first[short[has]] + j] * PLACE[j]
        rows, found = np.concatenate([rows, short]), np.concatenate([found, mix(total)])
    return rows, found


def shingle_sets(h: np.ndarray, first: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles by row, each row's sorted: (rows + 1 offsets, row of each, hash of each)."""
    rows, found = shingles(h, first, width)
    order = np.lexsort((found, rows))
    rows, found = rows[order], found[order]
    keep = np.ones(len(rows), bool)
    keep[1:] = (rows[1:] != rows[:-1]) | (found[1:] != found[:-1])
    rows, found = rows[keep], found[keep]
    return np.searchsorted(rows, np.arange(len(first))), rows, found


def row_sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums between consecutive offsets; rows may be empty."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype.kind in "uf" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def set_keys(off: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each row's set: equal sets get equal keys."""
    n = (off[1:] - off[:-1]).astype(np.uint64)
    one = row_sums(mix(found * PLACE[1]), off) + n * PLACE[2]
    two = row_sums(mix(found ^ PLACE[3]), off) * PLACE[4] + n
    return mix(one), mix(two)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def lists(off: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(values))


def source() -> Column:
    """A number to find a row's text again: its doc_id, or a hash of its text where that is NULL. Rows may share one."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64("text"))


def give_back() -> None:
    """Returns to the system what Arrow's and the C library's allocators keep for later."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)


def tidied(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``: at the end of a task its Python worker, which stays for the next one, gives back what nothing uses."""

    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidy


def per_slice(column: str, make: Callable[[Texts, pa.RecordBatch], pa.RecordBatch], lower: bool = False):
    """A function for ``mapInArrow``: ``make`` gets each slice of ``column`` and the batch rows it covers."""

    def run(batches):
        for batch in batches:
            for texts in slices(batch.column(column), lower):
                yield make(texts, batch.slice(texts.low, texts.rows))

    return tidied(run)
