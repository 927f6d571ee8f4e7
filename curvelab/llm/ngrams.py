"""Hashed character n-grams of words, in numpy.

A word stands between two spaces; its n-grams of 1 to ``LONGEST`` characters, the spaces included
(a space alone is none), are hashed to ``2 ** bits`` features.  A word of more than ``CUT`` characters
counts as several of at most that many.
"""

from __future__ import annotations

import numpy as np

LONGEST, CUT = 4, 256

_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _spread(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. counts[0] - 1, 0, 1, .. counts[1] - 1, ..."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)


def word_features(words: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(features, ends): the features of all words in order, those of word i before ``ends[i]`` and
    from ``ends[i - 1]`` on; an n-gram that a word holds twice is there twice."""
    pieces, owner = [], []
    for i, word in enumerate(words):
        for a in range(0, max(1, len(word)), CUT):
            pieces.append(word[a : a + CUT])
            owner.append(i)
    if not pieces:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    letters = np.frombuffer((" " + " ".join(pieces) + " ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    length = np.array([len(p) for p in pieces], np.int64) + 2
    start = np.cumsum(length - 1) - (length - 1)
    skip = np.array([1] + [0] * (LONGEST - 1))  # no space alone
    counts = np.maximum(length - np.arange(1, LONGEST + 1)[:, None] + 1 - 2 * skip[:, None], 0)
    of_piece = counts.sum(axis=0)
    put = np.cumsum(of_piece) - of_piece
    found = np.empty(int(of_piece.sum()), np.int64)
    rolling = letters
    for n in range(1, LONGEST + 1):
        if n > 1:
            rolling = rolling[:-1] * _STEP + letters[n - 1 :]
        c = counts[n - 1]
        step = _spread(c)
        mixed = (rolling[np.repeat(start + skip[n - 1], c) + step] + np.uint64(n)) * _MIX
        mixed = (mixed ^ (mixed >> np.uint64(32))) * _STEP
        found[np.repeat(put, c) + step] = mixed >> np.uint64(64 - bits)
        put = put + c
    return found, np.cumsum(np.bincount(owner, of_piece, len(words)).astype(np.int64))


def expand(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``codes``, place in the features) of every feature of the words ``codes``."""
    starts = np.concatenate([[0], ends[:-1]])
    counts = ends[codes] - starts[codes]
    return np.repeat(np.arange(len(codes)), counts), np.repeat(starts[codes], counts) + _spread(counts)
