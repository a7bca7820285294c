"""Whole-batch text kernels on numpy arrays: UTF-8 buffers, words, 64-bit hashes of words and of word windows."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once, to stay in the CPU cache and bound memory. A longer text is handled alone.
SLICE_BYTES = 1 << 18

#: ASCII white space, as the class [\x20\x09-\x0D].
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True

_U = np.uint64
_GOLDEN = 0x9E3779B97F4A7C15


def memo() -> dict:
    """What a Python worker keeps between tasks (functions travel by value, so module globals do not stay)."""
    return sys.__dict__.setdefault("_tempora_memo", {})


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (Stafford's variant 13), in place."""
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """M**i and M**-i modulo 2**64 for i < n at least."""
    kept = memo()
    if "powers" not in kept or len(kept["powers"][0]) < n:
        m = 0xD1342543DE82EF95
        size = 1 << max(19, int(n).bit_length())
        both = []
        for base in (m, pow(m, -1, 1 << 64)):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            both.append(np.cumprod(a, dtype=np.uint64))
        kept["powers"] = tuple(both)
    return kept["powers"]


def byte_values() -> np.ndarray:
    kept = memo()
    if "bytes" not in kept:
        kept["bytes"] = mix(np.arange(1, 257, dtype=np.uint64) * _U(_GOLDEN))
    return kept["bytes"]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """c with c[j] - c[i] = sum of values[i:j] * M**position, the basis of range hashes."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0][: len(values)], out=out[1:])
    return out


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range; equal content and length give equal hashes wherever the range lies."""
    h = (sums[ends] - sums[starts]) * powers(len(sums))[1][starts]
    h += (ends - starts).astype(np.uint64) * _U(_GOLDEN)
    return mix(h)


def window_hashes(sums: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    return range_hashes(sums, starts, starts + width)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # of no chunk or too large for one
        column = pa.concat_arrays([c.cast(pa.large_string()) for c in column.chunks]) if column.num_chunks else pa.array([], pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    data = data[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The string column of a buffer and offsets."""
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data)))


def lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The list column of flat values and offsets."""
    return pa.ListArray.from_arrays(pa.array(np.ascontiguousarray(offsets, np.int32)), pa.array(values))


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most limit bytes; each has a row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


class Words:
    """The words ([^\\x20\\x09-\\x0D]+) of rows i..j of a column.

    data: the rows' bytes, a space after each row; starts, ends: of each word in data; row: of each word, from 0;
    first: index of each row's first word, n + 1 entries; hashes: one a word.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, i: int, j: int):
        n = j - i
        lengths = np.diff(offsets[i : j + 1])
        self.row_starts = np.zeros(n + 1, np.int64)
        np.cumsum(lengths + 1, out=self.row_starts[1:])
        part = np.full(self.row_starts[-1], 0x20, np.uint8)
        hole = np.ones(len(part), bool)
        hole[self.row_starts[1:] - 1] = False
        part[hole] = data[offsets[i] : offsets[j]]
        self.data = part
        inside = ~IS_SPACE[part]
        edge = np.empty(len(part), bool)
        edge[:1] = inside[:1]
        np.logical_and(inside[1:], ~inside[:-1], out=edge[1:])
        self.starts = np.flatnonzero(edge)
        np.logical_and(~inside[1:], inside[:-1], out=edge[1:])
        edge[:1] = False
        self.ends = np.flatnonzero(edge)
        self.first = np.searchsorted(self.starts, self.row_starts)
        self.counts = np.diff(self.first)
        self.row = np.repeat(np.arange(n), self.counts)
        self.n = n

    def hashes(self) -> np.ndarray:
        return range_hashes(prefix_sums(byte_values()[self.data]), self.starts, self.ends)

    def window_starts(self, width: int) -> np.ndarray:
        """Indexes of the words that start a window of that many words of one row."""
        left = np.repeat(self.first[1:], self.counts) - np.arange(len(self.starts))
        return np.flatnonzero(left >= width)


def uniform(keys: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from 64-bit keys; the keys are spent."""
    return (mix(keys) >> _U(11)).astype(np.float64) * 2.0**-53


def row_keys(ids: pa.Array | pa.ChunkedArray, seed: int = 0) -> np.ndarray:
    """A 64-bit key a row from its id (null: a key of its own)."""
    if isinstance(ids, pa.ChunkedArray):
        ids = ids.combine_chunks()
    if not pa.types.is_integer(ids.type):
        data, offsets = utf8(ids.cast(pa.string()))
        keys = range_hashes(prefix_sums(byte_values()[data]), offsets[:-1], offsets[1:])
    else:
        keys = ids.fill_null(-(1 << 62)).cast(pa.int64()).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64).copy()
    return mix(keys + _U((seed * _GOLDEN + _GOLDEN) % (1 << 64)))
