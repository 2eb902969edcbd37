"""Words, shingles and hashes of whole texts, computed on numpy byte arrays inside tasks.

Texts come as Arrow string arrays; a null counts as empty. A batch is worked off in slices of about
``SLICE_BYTES`` (one document at least), so memory does not depend on the batch size. All hashes are
64 bits, the same in every process.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
# Fixed odd multipliers of the hashes.
MULTIPLIER = 0x9E3779B97F4A7C15
MIX1, MIX2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def process_store() -> dict:
    """A dict of this process.

    Functions travel by value, so their globals are made anew for each task; what should be made once
    in a worker, and not linger until the collector finds it, is kept here.
    """
    name = "ledgerloom_process_store"
    if name not in sys.modules:
        sys.modules[name] = ModuleType(name)
    return sys.modules[name].__dict__


def give_back() -> None:
    """Returns this process's freed memory to the machine: workers wait for tasks of other stages with what they keep."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(MIX1)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(MIX2)
    return x ^ (x >> np.uint64(31))


def random_numbers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(MULTIPLIER) + np.uint64(seed))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64, at least ``n`` of each."""
    _powers = process_store()
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", MULTIPLIER), ("down", pow(MULTIPLIER, -1, 1 << 64))):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of the rows in the bytes), a slice at a time."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1]
    offsets = offsets.astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + SLICE_BYTES, "right")) - 1)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


# Byte classes: white space is 0x20 and 0x09-0x0D; letters for word bags are ASCII letters and all bytes from 0x80.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
LETTER = np.zeros(256, bool)
LETTER[list(range(0x41, 0x5B)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def word_bounds(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = NOT_SPACE):
    """Starts and ends of all words, and the first word of each row (one entry more than rows)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = kind[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(inside & (np.concatenate(([True], ~inside[:-1])) | first[:-1]))
    ends = np.flatnonzero(inside & (np.concatenate((~inside[1:], [True])) | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span, by one running sum over the bytes."""
    up, down = powers(len(data) + 1)
    values = random_numbers(256, 7)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * up[: len(data)], out=sums[1:])
        spans = (sums[ends] - sums[starts]) * down[starts]
        return mix64(spans + (ends - starts).astype(np.uint64) * np.uint64(MIX2))


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = NOT_SPACE, lower: bool = True):
    """Hashes of the words of all rows and the first word of each row."""
    if lower:
        data = LOWER[data]
    starts, ends, rows = word_bounds(data, offsets, kind)
    return span_hashes(data, starts, ends), rows


def shingles(hashes: np.ndarray, rows: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each row; fewer words than ``size`` are one shingle."""
    factors = random_numbers(size, 11) | np.uint64(1)
    n = len(hashes)
    with np.errstate(over="ignore"):
        total = np.zeros(max(0, n - size + 1), np.uint64)
        for j in range(size):
            total += hashes[j : j + len(total)] * factors[j]
        total = mix64(total)
        found = []
        for low, high in zip(rows[:-1].tolist(), rows[1:].tolist()):
            if high - low >= size:
                one = np.sort(total[low : high - size + 1])
                found.append(one[np.concatenate(([True], one[1:] != one[:-1]))])
            elif high > low:
                short = (hashes[low:high] * factors[: high - low]).sum(dtype=np.uint64, keepdims=True)
                found.append(mix64(short + np.uint64(high - low)))
            else:
                found.append(np.zeros(0, np.uint64))
    return found
