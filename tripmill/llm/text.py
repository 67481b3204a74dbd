"""Vectorised word splitting and hashing over Arrow string columns.

Hashes are 64 bits and depend on the bytes of a word only, so they agree between tasks,
runs and machines. Words of up to eight bytes cannot collide with words of their own
length: every step is a bijection there.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: ASCII white space: \x09-\x0D and \x20.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True
#: Text bytes worked on at a time, which bounds the memory of a task (one text may be longer).
PIECE_BYTES = 1 << 20
_LANE_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=U64)


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc


def release() -> None:
    """Gives free memory back to the system, as Python processes outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``limit`` bytes of text each, one row at least."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    begin, done = 0, 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(begin, end - begin)
        begin, done = end, int(ends[end - 1])
    release()


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each text begins (and the last one ends).
    Null counts as empty."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    if data is None or not len(at):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SEPARATOR):
    """Start and end byte of every word, and the first word of each text (and one past the
    last). No word spans two texts."""
    n = len(data)
    inside = ~separator[data]
    begins, ends = inside.copy(), inside.copy()
    if n:
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edge = offsets[(offsets > 0) & (offsets < n)]
        begins[edge] = inside[edge]
        ends[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64 bits."""
    x = x ^ (x >> U64(32))
    x = x * U64(0x9FB21C651E98DF25)
    x ^= x >> U64(29)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, eight bytes per step."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    lanes = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    length = ends - starts
    h = mix(length.astype(U64) * U64(0x9E3779B97F4A7C15) ^ (lanes[starts] & _LANE_MASK[np.minimum(length, 8)]))
    done = 8
    more = np.flatnonzero(length > done)
    while len(more):
        lane = lanes[starts[more] + done] & _LANE_MASK[np.minimum(length[more] - done, 8)]
        h[more] = mix(h[more] * U64(0xA24BAED4963EE407) ^ lane)
        done += 8
        more = more[length[more] > done]
    return h


def same_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray) -> bool:
    """Whether every word has the bytes of the word whose number ``other`` gives for it."""
    length = ends - starts
    if (length != length[other]).any():
        return False
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    lanes = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    done, more = 0, np.flatnonzero(length > 0)
    while len(more):
        mask = _LANE_MASK[np.minimum(length[more] - done, 8)]
        if ((lanes[starts[more] + done] ^ lanes[starts[other[more]] + done]) & mask).any():
            return False
        done += 8
        more = more[length[more] > done]
    return True


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Hashes of the distinct words in ascending order, a word with each, and for each word the
    number of its hash; None where two words share a hash."""
    hashes, some, number = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
    return (hashes, some, number) if same_words(data, starts, ends, some[number]) else None


def distinct_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The distinct words, and for each word its number among them."""
    _, some, number = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
    whole = data.tobytes()
    if same_words(data, starts, ends, some[number]):
        return [whole[a:b] for a, b in zip(starts[some].tolist(), ends[some].tolist())], number
    found: dict[bytes, int] = {}  # two words share a hash
    every = [whole[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    number = np.array([found.setdefault(w, len(found)) for w in every], np.int64)
    return list(found), number


def ascii_lower(data: np.ndarray) -> np.ndarray:
    return data + (((data >= 65) & (data <= 90)) * np.uint8(32))


def gather(values: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """values[begin:begin + length] of every run, one after another."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(begin - (ends - length), length)]


class Spans:
    """Hashes of any runs of consecutive word hashes, from prefix sums.

    The sum of ``h[i] * base**i`` is taken modulo 2**64; dividing by the power of the
    first position makes it independent of where the run stands.
    """

    _base, _inverse = 0x5851F42D4C957F2D, pow(0x5851F42D4C957F2D, -1, 1 << 64)
    _up = _down = np.ones(1, U64)

    def __init__(self, hashes: np.ndarray):
        n = len(hashes) + 1
        if len(Spans._up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("_up", self._base), ("_down", self._inverse)):
                powers = np.full(size, base, U64)
                powers[0] = 1
                setattr(Spans, name, np.cumprod(powers, dtype=U64))
        self._sums = np.zeros(n, U64)
        np.cumsum(hashes * Spans._up[: n - 1], dtype=U64, out=self._sums[1:])

    def plain(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Not scrambled: good where the hashes themselves are, and the runs equally long."""
        return (self._sums[end] - self._sums[begin]) * Spans._down[begin]

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.plain(begin, end) ^ ((end - begin).astype(U64) * U64(0xC2B2AE3D27D4EB4F)))
