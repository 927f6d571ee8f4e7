"""Word shingles and min-max signatures of whole texts (numpy, one Arrow batch at a time).

A word is a maximal run of bytes outside ``\\x20 \\x09-\\x0D`` after lower-casing
A-Z only.  A text's shingles are its distinct runs of ``width`` words; a text with
fewer words has its whole sequence as its one shingle; a text without words, or a
null text, has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from curvelab.llm.words import flat_bytes, runs

_U64 = np.uint64


def _odd_constants(seed: int, n: int, dtype) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return rng.integers(0, np.iinfo(dtype).max, n, dtype=dtype, endpoint=True) | dtype(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> _U64(33))
    x = x * _U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U64(33))
    x = x * _U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U64(33))


_NO_SPACE = np.ones(256, dtype=bool)
_NO_SPACE[list(b" \t\n\x0b\x0c\r")] = False


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a batch in order, and ``len(texts) + 1`` offsets into them."""
    data, edges = flat_bytes(texts)
    if len(data) == 0:
        return pa.array([], pa.large_string()), np.zeros(len(texts) + 1, np.int64)
    capital = (data >= 0x41) & (data <= 0x5A)
    data = data | (capital.view(np.uint8) << np.uint8(5))
    _, is_word, pieces, owner = runs(data, edges, _NO_SPACE[data])
    sizes = np.bincount(owner[is_word], minlength=len(texts))
    return pieces.filter(pa.array(is_word)), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit content hash of every word; each distinct word of the batch is hashed once."""
    if len(words) == 0:
        return np.empty(0, dtype=np.uint64)
    coded = pc.dictionary_encode(words)
    digest = xxhash.xxh3_64_intdigest
    distinct = np.fromiter(
        (digest(w) for w in coded.dictionary.to_pylist()), dtype=np.uint64, count=len(coded.dictionary)
    )
    return distinct[coded.indices.to_numpy(zero_copy_only=False)]


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (uint64) of every text of the batch."""
    words, offsets = split_words(texts)
    hashes = word_hashes(words)
    coef = _odd_constants(101, width, np.uint64)
    n = len(hashes)
    runs = np.zeros(max(0, n - width + 1), dtype=np.uint64)
    for j in range(width):
        runs += hashes[j : j + len(runs)] * coef[j]
    runs = mix64(runs)
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(runs[a : b - width + 1]))
        elif b > a:
            whole = (hashes[a:b] * coef[: b - a]).sum(dtype=np.uint64) + _U64(b - a)
            out.append(mix64(np.array([whole], dtype=np.uint64)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


class MinMax:
    """Min-max hashing: each permutation keeps its minimum and its maximum, so
    ``permutations`` hash evaluations a shingle give ``2 * permutations`` values.

    Both ends estimate the same similarity and are nearly uncorrelated, so the
    bands take them alike: the first half of the bands groups minima, the second
    half groups the maxima of the same permutations.
    """

    def __init__(self, permutations: int = 64, rows: int = 4, seed: int = 7):
        if permutations % rows:
            raise ValueError("permutations must be a multiple of rows")
        self.permutations, self.rows = permutations, rows
        self.bands = 2 * permutations // rows
        self.a = _odd_constants(seed, permutations, np.uint32)
        self.b = _odd_constants(seed + 1, permutations, np.uint32)
        self.band_coef = _odd_constants(seed + 2, rows, np.uint64)

    def signatures(self, sets: list[np.ndarray], block: int = 1 << 15) -> np.ndarray:
        """uint32 matrix (texts, 2 * permutations): minima, then maxima; empty sets give zeros."""
        k = self.permutations
        out = np.zeros((len(sets), 2 * k), dtype=np.uint32)
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        live = np.flatnonzero(sizes)
        start = 0
        while start < len(live):
            stop, total = start, 0
            while stop < len(live) and (total == 0 or total + sizes[live[stop]] <= block):
                total += sizes[live[stop]]
                stop += 1
            rows = live[start:stop]
            x = (np.concatenate([sets[i] for i in rows]) >> _U64(32)).astype(np.uint32)
            at = np.concatenate([[0], np.cumsum(sizes[rows])[:-1]])
            h = np.empty_like(x)
            for j in range(k):
                np.multiply(x, self.a[j], out=h)
                np.add(h, self.b[j], out=h)
                out[rows, j] = np.minimum.reduceat(h, at)
                out[rows, k + j] = np.maximum.reduceat(h, at)
            start = stop
        return out

    def band_keys(self, signatures: np.ndarray) -> np.ndarray:
        """int64 matrix (texts, bands); equal keys mean equal values in the whole band."""
        grouped = signatures.reshape(len(signatures), self.bands, self.rows).astype(np.uint64)
        keys = (grouped * self.band_coef).sum(axis=2, dtype=np.uint64)
        keys += np.arange(1, self.bands + 1, dtype=np.uint64) * _U64(0x9E3779B97F4A7C15)
        return mix64(keys).view(np.int64)
