"""A hash table over integers that is built and probed for whole arrays at once."""

from __future__ import annotations

import numpy as np


class IntTable:
    """Open addressing with linear probing: ``get`` gives the value of each key, ``missing`` where there is none. Keys are distinct and not -1."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing):
        self.bits = max(4, (2 * len(keys)).bit_length())
        self.keys, self.values, self.missing = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, missing, values.dtype), missing
        keys, at = keys.astype(np.int64), self._slot(keys)
        while len(keys):
            free = self.keys[at] == -1
            self.keys[at[free]], self.values[at[free]] = keys[free], values[free]
            lost = self.keys[at] != keys  # the slot went to another key: the next one
            # of two keys that meet in a free slot the last writer stays, and its value with it
            keys, values, at = keys[lost], values[lost], (at[lost] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, key: np.ndarray) -> np.ndarray:
        at = self._slot(key)
        found = self.keys[at]
        out = self.values[at]
        off = np.flatnonzero(found != key)
        if len(off):
            out[off] = self.missing
            off = off[found[off] != -1]
        while len(off):
            at[off] = (at[off] + 1) & ((1 << self.bits) - 1)
            found = self.keys[at[off]]
            hit = found == key[off]
            out[off[hit]] = self.values[at[off[hit]]]
            off = off[~hit & (found != -1)]
        return out
