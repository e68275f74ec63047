"""Shingle sets and fast similarity sketches of texts (numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .common import ASCII_LOWER, byte_chunks, mix64, run_hashes

WORDS = 5
#: Coordinates of a sketch; a power of two.
BINS = 128

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Everything but ASCII letters, digits and bytes of longer characters.
NOT_WORD = np.ones(256, bool)
NOT_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_ODD = mix64(np.arange(64, dtype=np.uint64), 99) | np.uint64(1)


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without ``space`` bytes) of all rows in
    ``data``, and how many words start before each row offset."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~space[data]
    starts = np.flatnonzero(inside[1:-1] & ~inside[:-2])
    ends = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    if len(starts):
        # A word that runs over the end of its row is two words.
        cuts = offsets[1:-1]
        cuts = np.unique(cuts[(cuts > 0) & (cuts < len(data))])
        cuts = cuts[inside[cuts] & inside[cuts + 1]]
        if len(cuts):
            starts = np.sort(np.concatenate([starts, cuts]))
            ends = np.sort(np.concatenate([ends, cuts]))
    return starts, ends, np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> Iterator[np.ndarray]:
    """Per row the sorted distinct 64-bit hashes of its word shingles; the whole
    word sequence as one shingle if it is shorter; empty without words."""
    for a, b in byte_chunks(offsets):
        part = offsets[a:b + 1] - offsets[a]
        low = ASCII_LOWER[data[offsets[a]:offsets[b]]]
        starts, ends, first = word_spans(low, part)
        hashes = run_hashes(low, starts, ends)
        n = len(hashes) - words + 1
        with np.errstate(over="ignore"):
            if n > 0:
                every = np.zeros(n, np.uint64)
                for k in range(words):
                    every += hashes[k:k + n] * _ODD[k]
                every = mix64(every, 3)
            for r in range(b - a):
                lo, hi = first[r], first[r + 1]
                if hi - lo >= words:
                    yield np.unique(every[lo:hi - words + 1])
                elif hi > lo:
                    short = (hashes[lo:hi] * _ODD[:hi - lo]).sum(dtype=np.uint64)
                    yield mix64(np.array([short], np.uint64), 5 + int(hi - lo))
                else:
                    yield np.zeros(0, np.uint64)


def set_hash(shingles: np.ndarray) -> tuple[int, int]:
    """A 128-bit hash of a sorted set, as two signed 64-bit numbers."""
    if not len(shingles):
        return 0, 0
    with np.errstate(over="ignore"):
        both = [mix64(shingles, k).sum(dtype=np.uint64) * _ODD[k] + np.uint64(len(shingles)) for k in (21, 22)]
    return tuple(int(x.astype(np.int64)) for x in both)


def _bits(bins: int) -> int:
    if bins < 2 or bins & (bins - 1):
        raise ValueError("bins must be a power of two")
    return bins.bit_length() - 1


def fast_similarity_sketch(shingles: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Sketch of a set (sorted distinct hashes) in which each coordinate agrees
    between two sets with the probability of their Jaccard similarity.

    In round i = 0 .. bins-1 every element is thrown into one bin with a value; a
    bin keeps the least (round, value).  Bins still empty after that are filled in
    rounds bins .. 2*bins-1, where every element goes to the round's own bin, so
    each coordinate is filled, with concentration as if all were independent.  The
    rounds end once no bin is empty: later ones could not change a bin."""
    shift = np.uint64(64 - _bits(bins))
    out = np.zeros(bins, np.uint64)
    empty = np.ones(bins, bool)
    n = len(shingles)
    if not n:
        return out
    left, done = bins, 0
    while left and done < bins:
        # As many rounds at once as would fill most bins by expectation.
        rounds = int(min(max(1, 2 * bins // n), bins - done))
        seeds = np.arange(done, done + rounds)
        thrown = np.concatenate([np.sort(mix64(shingles, 1000 + int(s))) for s in seeds])
        where = (thrown >> shift).astype(np.int64)
        bin_of, at = np.unique(where, return_index=True)  # the first: least round, then least value
        new = empty[bin_of]
        bin_of, at = bin_of[new], at[new]
        out[bin_of] = mix64(thrown[at], 3) ^ (seeds[at // n].astype(np.uint64) << np.uint64(48))
        empty[bin_of] = False
        left -= len(bin_of)
        done += rounds
    for b in np.flatnonzero(empty):
        out[b] = mix64(shingles, 1000 + bins + int(b)).min()
    return out


def band_hashes(sketch: np.ndarray, rows: int) -> np.ndarray:
    """One signed 64-bit hash for each run of ``rows`` coordinates."""
    parts = sketch.reshape(-1, rows)
    with np.errstate(over="ignore"):
        return mix64((mix64(parts, 31) * _ODD[:rows]).sum(axis=1, dtype=np.uint64), 32).astype(np.int64)
