"""Vectorised word scanning over Arrow text columns.

All functions work on UTF-8 bytes of a chunk of whole texts. A chunk holds about ``CHUNK`` bytes, or one
text if that is longer; nothing is cut. Words are runs of bytes that are not separators, so every class of
separators is a set of single bytes. Hashes are 64-bit and do not depend on the machine or the process.
"""

from __future__ import annotations

import ctypes
import ctypes.util
import functools
import gc
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 21
U64 = np.uint64

#: separators of ``[^\\x20\\x09-\\x0D]+``
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: separators of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, for lower-cased bytes
NOT_WORD = np.zeros(256, bool)
NOT_WORD[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit reaches every output bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=U64) + U64(seed * 1_000_003)) | U64(1)


_BYTE = constants(256, 1)
_BASE = U64(0x9E3779B97F4A7C15)
_BASE_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64; long tables are not kept."""
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = max(n, CHUNK + 1)
        up, down = np.full(size, _BASE, U64), np.full(size, _BASE_INVERSE, U64)
        up[0] = down[0] = 1
        np.cumprod(up, out=up)
        np.cumprod(down, out=down)
        if size > 4 * CHUNK:
            return up, down
        _powers.update(up=up, down=down)
    return _powers["up"], _powers["down"]


@dataclass
class Texts:
    """Consecutive rows of a text column: their bytes, and where each text begins (one more entry than rows)."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[Texts]:
    """The texts of a column in chunks; a null counts as an empty text."""
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return
    _, place, data = column.buffers()
    offsets = np.frombuffer(place, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield Texts(lo, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


@dataclass
class Words:
    """Words of a chunk in text order: row within the chunk, byte span and hash."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    per_row: np.ndarray

    def first_of_row(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.per_row)[:-1]]).astype(np.int64)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """``h`` with ``span_hash(h, s, e)`` as the hash of any span."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of True that end at row borders: (row, start, end)."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    borders = offsets[(offsets > 0) & (offsets < n)]
    before[borders] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[borders - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return np.searchsorted(offsets, start, "right") - 1, start, end


def words(texts: Texts, separators: np.ndarray, lower: bool) -> Words:
    data = LOWER[texts.data] if lower else texts.data
    row, start, end = spans(~separators[data], texts.offsets)
    return Words(row, start, end, span_hash(prefix_hash(data), start, end), np.bincount(row, minlength=texts.rows))


def shingles(w: Words, size: int, whole_if_short: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every window of ``size`` words.

    With ``whole_if_short`` a row of fewer, but some, words has its whole sequence as one shingle.
    """
    weight = constants(size + 1, 2)
    n = len(w.hash) - size + 1
    rows, hashes = [np.zeros(0, np.int64)], [np.zeros(0, U64)]
    if n > 0:
        total = np.zeros(n, U64)
        for j in range(size):
            total += w.hash[j : j + n] * weight[j]
        same = w.row[:n] == w.row[size - 1 :]
        rows.append(w.row[:n][same])
        hashes.append(mix(total[same]))
    if whole_if_short:
        first = w.first_of_row()
        for m in range(1, size):
            short = np.flatnonzero(w.per_row == m)
            if len(short):
                total = np.full(len(short), int(weight[size]) * m % (1 << 64), U64)
                for j in range(m):
                    total += w.hash[first[short] + j] * weight[j]
                rows.append(short)
                hashes.append(mix(total))
    return np.concatenate(rows), np.concatenate(hashes)


def distinct(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, value), sorted by both."""
    order = np.argsort(value)
    order = order[np.argsort(row[order].astype(np.int32), kind="stable")]
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def row_sums(row: np.ndarray, amount: np.ndarray, rows: int) -> np.ndarray:
    """Integer sum of ``amount`` for each row."""
    out = np.zeros(rows, np.int64)
    np.add.at(out, row, amount)
    return out


def release_memory() -> None:
    """Give free memory of this process back, and the tables of powers; a Python worker stays for later tasks, of other operators too."""
    _powers.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    libc = ctypes.util.find_library("c")
    trim = getattr(ctypes.CDLL(libc), "malloc_trim", None) if libc else None
    if trim is not None:
        trim(0)


def frees_memory(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of Arrow batches that gives free memory back when its task ends."""

    @functools.wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            release_memory()

    return run
