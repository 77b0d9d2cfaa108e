"""Fuzzy keys for 64-bit fingerprints from the binary Golay code.

The perfect [23, 12, 7] code puts every 23-bit word within three bits of exactly one
codeword. A word at distance 3 has five further codewords at distance 4; a word nearer
than that has none. So for two words that differ in at most one bit, the codeword
nearest to either is always in the other's list of codewords within four bits.

A fingerprint is cut into three segments. Of at most three differing bits, at most one
segment can hold two or more, so at least two segments differ in one bit at most, and
for that pair of segments both lists hold the other's nearest codewords. A key is a
pair of segments with one codeword index of each.
"""

from __future__ import annotations

import itertools

import numpy as np

# Length, dimension and generator polynomial of the code.
LENGTH, DIMENSION, GENERATOR = 23, 12, 0b110001110101
CHECKS = LENGTH - DIMENSION

SEGMENTS = ((0, 21), (21, 21), (42, 22))  # (lowest bit, bits)
PAIRS = tuple(itertools.combinations(range(len(SEGMENTS)), 2))
MAX_DISTANCE = 3


def _remainder(words: np.ndarray) -> np.ndarray:
    """The syndrome: the word, as a polynomial over GF(2), modulo the generator."""
    rest = words.astype(np.int64)
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - CHECKS), 0)
    return rest


def _patterns(weight: int) -> np.ndarray:
    bits = [1 << b for b in range(LENGTH)]
    return np.array([sum(c) for c in itertools.combinations(bits, weight)], dtype=np.int64)


def _errors_by_syndrome() -> np.ndarray:
    """Row: syndrome. Column 0: its error of weight 3 at most; then those of weight 4, or -1."""
    table = np.full((1 << CHECKS, 6), -1, dtype=np.int64)
    for weight in range(4):
        errors = _patterns(weight)
        table[_remainder(errors), 0] = errors
    errors = _patterns(4)
    syndromes = _remainder(errors)
    order = np.argsort(syndromes, kind="stable")
    syndromes, errors = syndromes[order], errors[order]
    first = np.searchsorted(syndromes, syndromes)
    table[syndromes, 1 + np.arange(len(errors)) - first] = errors
    return table


_ERRORS = _errors_by_syndrome()


def codeword_indices(words: np.ndarray) -> np.ndarray:
    """(n, 6) indices of the codewords within four bits; column 0 is the nearest, -1 is none.

    The code is cyclic and systematic here: the upper twelve bits number the codeword.
    """
    errors = _ERRORS[_remainder(words)]
    found = (words.astype(np.int64)[:, None] ^ errors) >> CHECKS
    return np.where(errors < 0, -1, found)


def fuzzy_keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of uint64 fingerprints: (nearest, all keys, row of each of all keys).

    ``nearest`` is (n, 3), one key per pair of segments. Whenever two fingerprints differ
    in at most MAX_DISTANCE bits, a nearest key of either is among all keys of the other.
    """
    near = []
    for low, bits in SEGMENTS:
        segment = fingerprints >> np.uint64(low) & np.uint64((1 << bits) - 1)
        near.append(codeword_indices(segment.astype(np.int64)))
    shift = DIMENSION
    nearest, keys, rows = [], [], []
    for number, (a, b) in enumerate(PAIRS):
        base = number << 2 * shift
        nearest.append(base | near[a][:, 0] << shift | near[b][:, 0])
        both = base | near[a][:, :, None] << shift | near[b][:, None, :]
        held = (near[a][:, :, None] >= 0) & (near[b][:, None, :] >= 0)
        rows.append(np.nonzero(held)[0])
        keys.append(both[held])
    return np.stack(nearest, axis=1), np.concatenate(keys), np.concatenate(rows)
