"""Encode texts unit by unit: each distinct unit is encoded once a worker, occurrences are gathered on numpy arrays."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd

_U = np.uint64


class UnitCache:
    """What encode() gave for the units seen so far: flat values, and start and length by 64-bit hash."""

    def __init__(self, dtype: type, most: int = 2_000_000):
        self.dtype, self.most = dtype, most
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int32)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int32)
        self.flat = np.zeros(0, self.dtype)

    def slots(self, hashes: np.ndarray, encode: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The slot of each unit; encode(i) gives flat values and lengths for the units first seen at the indexes i."""
        codes, unique = pd.factorize(hashes)
        first = np.empty(len(unique), np.int64)
        first[codes[::-1]] = np.arange(len(hashes) - 1, -1, -1)
        if len(self.known) + len(unique) > self.most and len(self.known):
            self.clear()
        at = np.searchsorted(self.known, unique)
        at[at == len(self.known)] = 0
        new = self.known[at] != unique if len(self.known) else np.ones(len(unique), bool)
        if new.any():
            values, lengths = encode(first[new])
            begin = len(self.start)
            ends = np.cumsum(lengths, dtype=np.int64)
            self.start = np.concatenate([self.start, ends - lengths + len(self.flat)])
            self.length = np.concatenate([self.length, lengths.astype(np.int32)])
            self.flat = np.concatenate([self.flat, values.astype(self.dtype)])
            known = np.concatenate([self.known, unique[new]])
            slot = np.concatenate([self.slot, np.arange(begin, len(self.start), dtype=np.int32)])
            order = np.argsort(known)
            self.known, self.slot = known[order], slot[order]
            at = np.searchsorted(self.known, unique)
        return self.slot[at][codes]

    def gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of all units in order, and the end of each unit's in them."""
        return ranges(self.flat, self.start[slots], self.length[slots])


def ranges(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """flat[start : start + length] of all pairs, joined, and the end of each in the result."""
    ends = np.cumsum(lengths, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    index = np.repeat(starts - (ends - lengths), lengths)
    index += np.arange(total)
    return flat[index], ends
