"""Words of whole texts as flat numpy arrays, for use inside Arrow tasks.

A batch of texts is taken in slices of a megabyte (one text is never
split), so a task's memory does not grow with the batch. Within a slice the
words of all texts lie one after the other; ``first[i]:first[i + 1]`` are the
words of text ``i``.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

U = np.uint64
_rng = np.random.default_rng(20240501)
_BYTE_CODE = _rng.integers(1, 2**64 - 1, 256, dtype=np.uint64)
_BASE = U(int(_rng.integers(1, 2**63)) * 2 + 1)
_WORD_BASE = U(int(_rng.integers(1, 2**63)) * 2 + 1)

IS_BREAK = np.zeros(256, bool)
IS_BREAK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def give_back() -> None:
    """Returns freed memory to the system: a Python worker outlives its task,
    and what it keeps counts against its executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def tidy(run: Callable) -> Callable:
    """``run``, the function of an Arrow task, giving memory back at its end."""

    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


class _Powers:
    """base**i and base**-i modulo 2**64, grown on demand."""

    def __init__(self, base: np.uint64):
        inverse = U(pow(int(base), -1, 1 << 64))
        self.steps = (base, inverse)
        self.tables = [np.ones(1, U), np.ones(1, U)]

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.tables[0]) < n:
            size = max(n, 2 * len(self.tables[0]))
            for k, step in enumerate(self.steps):
                table = np.full(size, step, U)
                table[0] = 1
                self.tables[k] = np.multiply.accumulate(table)
        return self.tables[0][:n], self.tables[1][:n]


_byte_powers = _Powers(_BASE)
_word_powers = _Powers(_WORD_BASE)


@dataclass
class Slice:
    row: int  # index of the first text in its batch
    data: np.ndarray  # uint8, the texts one after the other
    offsets: np.ndarray  # byte offsets of the texts
    starts: np.ndarray  # byte offsets of the words
    ends: np.ndarray
    first: np.ndarray  # word index at which each text starts

    @property
    def n_texts(self) -> int:
        return len(self.offsets) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_texts), self.counts)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2] if len(column) else None
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(column, lower: bool = False, slice_bytes: int | None = None, is_break: np.ndarray = IS_BREAK) -> Iterator[Slice]:
    data, offsets = utf8(column)
    n, row = len(offsets) - 1, 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + (slice_bytes or SLICE_BYTES), "right")) - 1
        end = min(n, max(end, row + 1))
        part, off = data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        if lower:
            part = LOWER[part]
        yield words(part, off, row, is_break)
        row = end


def words(data: np.ndarray, offsets: np.ndarray, row: int = 0, is_break: np.ndarray = IS_BREAK) -> Slice:
    gap = is_break[data]
    before = np.ones(len(data) + 1, bool)
    before[1:] = gap
    after = before[1:].copy()
    after[:-1] = gap[1:]
    if len(data):
        after[-1] = True
        bounds = offsets[1:-1]
        before[bounds] = True
        after[bounds[bounds > 0] - 1] = True
    starts = np.flatnonzero(~gap & before[:-1])
    ends = np.flatnonzero(~gap & after) + 1
    return Slice(row, data, offsets, starts, ends, np.searchsorted(starts, offsets))


def word_hashes(s: Slice) -> np.ndarray:
    """64-bit hash of every word's bytes."""
    n = len(s.data)
    if not n:
        return np.zeros(0, U)
    power, inverse = _byte_powers.upto(n + 1)
    total = np.zeros(n + 1, U)
    np.cumsum(_BYTE_CODE[s.data] * power[:n], out=total[1:])
    return mix((total[s.ends] - total[s.starts]) * inverse[s.starts] + (s.ends - s.starts).astype(U))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every run of ``k`` consecutive word hashes (runs that
    cross from one text into the next are included; mask them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    power, inverse = _word_powers.upto(len(h) + 1)
    total = np.zeros(len(h) + 1, U)
    np.cumsum(h * power[:-1], out=total[1:])
    return mix((total[k:] - total[:-k]) * inverse[:n])


def room(s: Slice) -> np.ndarray:
    """For every word, how many words its text has from it on."""
    return np.repeat(s.first[1:], s.counts) - np.arange(len(s.starts))


def join_words(s: Slice, keep: np.ndarray | None = None) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The (kept) words with one space after each, and where each starts and
    ends in that buffer."""
    starts, ends = (s.starts, s.ends) if keep is None else (s.starts[keep], s.ends[keep])
    size = ends - starts + 1
    out_end = np.cumsum(size)
    out_start = out_end - size
    inside = np.ones(int(out_end[-1]) if len(size) else 0, bool)
    inside[out_end - 1] = False
    out = np.full(len(inside), 0x20, np.uint8)
    edge = np.zeros(len(s.data) + 1, np.int8)
    edge[starts] += 1
    edge[ends] -= 1
    out[inside] = s.data[np.cumsum(edge[:-1]).astype(bool)]
    return out.tobytes(), out_start, out_end - 1
