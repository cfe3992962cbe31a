"""Word shingles of whole texts as sorted sets of 64-bit hashes, and one-permutation signatures of such sets."""

from __future__ import annotations

import hashlib

import numpy as np

from trajlake.llm.common import U64, mix64

_P = U64(0x9E3779B97F4A7C15)
_K = U64(0xD6E8FEB86659FD93)
_POWERS: dict[str, np.ndarray] = {}
#: Bytes of text hashed at once; a longer text is cut at white space.
PIECE = 1 << 21
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64) + U64(1)
_LOWER[65:91] += U64(32)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse modulo 2^64."""
    if len(_POWERS.get("p", ())) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            for name, base in (("p", int(_P)), ("q", pow(int(_P), -1, 1 << 64))):
                steps = np.full(size, base, U64)
                steps[0] = 1
                _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["p"], _POWERS["q"]


def _hash_words(data: np.ndarray) -> np.ndarray:
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    p, q = _powers(len(data))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum(_LOWER[data] * p[: len(data)], out=sums[1:])
        h = (sums[end] - sums[start]) * q[start]
        return mix64(h + (end - start).astype(U64) * _K)


def word_hashes(text: str) -> np.ndarray:
    """One hash for each run of characters other than space and the controls 9 to 13, letters A-Z lower-cased."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if len(data) <= PIECE:
        return _hash_words(data)
    out, at = [], 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        size = PIECE
        while end < len(data) and not _SPACE[data[end]]:  # to the end of the word
            stop = np.flatnonzero(_SPACE[data[end : end + size]])
            end = end + int(stop[0]) if stop.size else min(end + size, len(data))
        out.append(_hash_words(data[at:end]))
        at = end
    return np.concatenate(out)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles of ``width`` words; of fewer words, the whole sequence; of none, nothing."""
    if not text:
        return np.zeros(0, U64)
    w = word_hashes(text)
    if not len(w):
        return w
    n = min(width, len(w))
    with np.errstate(over="ignore"):
        h = w[: len(w) - n + 1].copy()
        for j in range(1, n):
            h = h * _K + w[j : len(w) - n + 1 + j]
        return np.unique(mix64(h + U64(n) * _P))


def set_key(s: np.ndarray) -> bytes:
    """128 bits that stand for a set; equal sets have equal keys."""
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


class OnePermutation:
    """Signatures by one permutation: the space of hashes is cut into bins, and a bin's value is that of its smallest hash.

    Densification is the optimal kind: an empty bin takes the value of a bin drawn at random, alike for all sets, from those that
    aren't empty; each bin tries all bins in a random order of its own.
    """

    def __init__(self, bands: int, rows: int, seed: int = 5) -> None:
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        rng = np.random.default_rng(seed)
        self.tries = rng.permuted(np.tile(np.arange(self.bins), (self.bins, 1)), axis=1)
        self.salt = rng.integers(1, 1 << 63, bands).astype(U64)

    def signature(self, s: np.ndarray) -> np.ndarray:
        """The values of all bins for a set of sorted hashes, not empty."""
        which = ((s >> U64(32)) * U64(self.bins)) >> U64(32)
        first = np.concatenate(([True], which[1:] != which[:-1]))
        filled, value = np.zeros(self.bins, bool), np.zeros(self.bins, U64)
        at = which[first].astype(np.int64)
        filled[at], value[at] = True, s[first]
        empty = np.flatnonzero(~filled)
        if empty.size:
            tries = self.tries[empty]
            value[empty] = value[tries[np.arange(empty.size), filled[tries].argmax(1)]]
        return value

    def buckets(self, s: np.ndarray) -> np.ndarray:
        """One signed 64-bit bucket for each band."""
        v = self.signature(s).reshape(self.bands, self.rows)
        h = self.salt.copy()
        with np.errstate(over="ignore"):
            for j in range(self.rows):
                h = mix64(h * _K + v[:, j])
        return h.view(np.int64)
