"""Word shingles and one-permutation signatures, in numpy, for the workers."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Words of a shingle.
WORDS = 5
#: Distinct words whose hashes a task keeps.
TABLE_ENTRIES = 300_000
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _Hashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted 64-bit hashes of the distinct shingles of a text.

    A-Z are lower-cased and words end at ASCII white space, as bytes.lower and bytes.split have it. A text of
    fewer words than a shingle has one, its whole sequence; a text without words has none.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(_HASHES) > TABLE_ENTRIES:
        _HASHES.clear()
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - WORDS + 1)
    total = np.full(n, min(len(words), WORDS), np.uint64)
    for k in range(min(len(words), WORDS)):
        total += mixed(h[k : k + n] + _ODD[k]) * _ODD[k]
    return np.unique(mixed(total))


@lru_cache
def _detours(bins: int) -> np.ndarray:
    """For each bin, the other bins in an order of its own: where an empty bin borrows its value."""
    rng = np.random.default_rng(20240601)
    return np.array([rng.permutation(bins) for _ in range(bins)], np.int32)


def signature(hashes: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation minima with optimal densification; bins must be a power of two, hashes sorted and not empty."""
    edges = np.arange(bins, dtype=np.uint64) << np.uint64(64 - int(bins).bit_length() + 1)
    first = np.searchsorted(hashes, edges)
    full = np.append(first[1:], len(hashes)) > first
    source = np.arange(bins)
    empty = np.flatnonzero(~full)
    if len(empty):
        detours = _detours(bins)
        for part in (slice(0, 16), slice(16, bins)):
            ways = detours[empty, part]
            hit = full[ways]
            at = hit.argmax(axis=1)
            found = hit[np.arange(len(empty)), at]
            source[empty[found]] = ways[np.flatnonzero(found), at[found]]
            empty = empty[~found]
            if not len(empty):
                break
    return hashes[first[source]]


def bands(hashes: np.ndarray, count: int, rows: int) -> np.ndarray:
    """count 64-bit keys, each of rows bins of the signature."""
    bins = 1 << (count * rows - 1).bit_length()
    values = mixed(signature(hashes, bins)[: count * rows].reshape(count, rows) + np.arange(1, rows + 1, dtype=np.uint64) * _ODD[0])
    with np.errstate(over="ignore"):
        return mixed(values.sum(axis=1, dtype=np.uint64) + np.arange(count, dtype=np.uint64) * _ODD[1])


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of two sorted sets."""
    both = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * both >= percent * (len(a) + len(b) - both)
