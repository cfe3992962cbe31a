"""Byte-pair merges of many short words at once in NumPy: of a word's pairs that one whose merge comes first in the file, the leftmost of such, again and again."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes of the longest word; words side by side, for which what is worked on stays in a processor's cache.
LONGEST, WORDS = 28, 8192
#: No symbol, another that is never asked for, and no merge; bits of a place in a word below a merge's number.
_GONE, _FREE, _NEVER, _PLACE = (1 << 16) - 1, (1 << 16) - 2, 1 << 26, 5
_ODDS, _SLOT_BITS = (0x9E3779B1, 0x85EBCA6B), 17


class Merges:
    """``encode`` gives the ids of words. ``first`` and ``last`` are the symbols of bytes within a word and at its end; ``pairs`` and ``made`` the merges in order."""

    def __init__(self, first: np.ndarray, last: np.ndarray, pairs: np.ndarray, made: np.ndarray) -> None:
        if max(int(first.max()), int(last.max()), int(pairs.max(initial=0)), int(made.max(initial=0))) >= _FREE or len(made) >= _NEVER:
            raise ValueError("ids of 16 bits alone")
        self.first, self.last, self.made = first.astype(np.uint32), last.astype(np.uint32), made.astype(np.uint32)
        keys = pairs[:, 0].astype(np.uint32) << np.uint32(16) | pairs[:, 1].astype(np.uint32)
        if len(np.unique(keys)) < len(keys):
            raise ValueError("a pair has two merges")
        # Two places are possible for each pair; one that takes another's place sends it to its other one.
        held = np.full((2, 1 << _SLOT_BITS), -1)
        rest, table = np.arange(len(keys)), 0
        for _ in range(500):
            if not len(rest):
                break
            slot = self._slots(keys[rest], table)
            before = held[table, slot]
            held[table, slot] = rest
            rest = np.unique(np.concatenate((before[before >= 0], rest[held[table, slot] != rest])))
            table = 1 - table
        else:
            raise ValueError("pairs don't fit")
        keys = np.append(keys, np.uint32(_FREE << 16 | _FREE)).astype(np.uint64)
        self.tables = (keys << np.uint64(32) | np.arange(len(keys), dtype=np.uint64))[held]

    @staticmethod
    def _slots(keys: np.ndarray, table: int) -> np.ndarray:
        return (keys * np.uint32(_ODDS[table]) >> np.uint32(32 - _SLOT_BITS)).astype(np.int64)

    def _of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of the merge of each pair of symbols, ``_NEVER`` if there is none."""
        keys = a << np.uint32(16)
        keys |= b
        wide = keys.astype(np.uint64) << np.uint64(32)
        found = self.tables[0].take(self._slots(keys, 0)) ^ wide
        np.minimum(found, self.tables[1].take(self._slots(keys, 1)) ^ wide, out=found)
        return np.minimum(found, np.uint64(_NEVER)).astype(np.uint32)

    def encode(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of 1 to ``LONGEST`` bytes in a row, and how many each has."""
        n = len(words)
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + n + 1]
        data = np.frombuffer(words.buffers()[2], np.uint8)
        size = np.diff(offsets)
        longest = int(size.max())
        # A row for each place, with one before the first and one after the last that hold no symbol.
        at = np.arange(longest)[:, None]
        letters = data.take(offsets[:-1] + at, mode="clip")
        symbols = np.full((longest + 2, n), _GONE, np.uint32)
        symbols[1:-1] = np.where(at < size - 1, self.first[letters], np.where(at == size - 1, self.last[letters], np.uint32(_GONE)))
        after = np.repeat(np.arange(1, longest + 3, dtype=np.int32)[:, None], n, 1)
        prior = after - 2
        place = np.arange(longest + 2, dtype=np.uint32)[:, None]
        best = np.full(symbols.shape, _NEVER << _PLACE, np.uint32)
        best[1:-2] = self._of(symbols[1:-2], symbols[2:-1]) << np.uint32(_PLACE) | place[1:-2]
        flat, after, prior, keys = symbols.reshape(-1), after.reshape(-1), prior.reshape(-1), best.reshape(-1)
        while True:
            first = best.min(0)
            own = (first < _NEVER << _PLACE).nonzero()[0]
            if not own.size:
                break
            first = first[own]
            p = (first & np.uint32((1 << _PLACE) - 1)).astype(np.int64)
            new = self.made.take(first >> np.uint32(_PLACE))
            ip = p * n + own
            iq = after[ip] * n + own
            follows, precedes = after[iq], prior[ip]
            i, j = follows * n + own, precedes * n + own
            flat[ip], flat[iq], keys[iq] = new, _GONE, _NEVER << _PLACE
            after[ip], prior[i] = follows, p
            keys[ip] = self._of(new, flat[i]) << np.uint32(_PLACE) | p.astype(np.uint32)
            keys[j] = self._of(flat[j], new) << np.uint32(_PLACE) | precedes.astype(np.uint32)
        rows = symbols[1:-1].T
        there = rows != _GONE
        return rows[there].astype("<u4"), there.sum(1)
