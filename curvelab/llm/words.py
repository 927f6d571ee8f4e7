"""Flat bytes of a batch of texts, and its words: maximal runs of letters and digits, lower-cased."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[[c for c in range(128) if chr(c).isalnum()]] = True
_IN_WORD[128:] = True  # letters of other scripts; marks of other scripts stay with their word


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a batch and ``len + 1`` offsets; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    begin, end = int(bounds[0]), int(bounds[-1])
    data = np.frombuffer(texts.buffers()[2], np.uint8)[begin:end] if end > begin else np.empty(0, np.uint8)
    return data, bounds - begin


def compact(texts: pa.Array) -> pa.Array:
    """The same texts without nulls, in buffers that start with the first of them (a slice of a batch
    shares the whole batch's buffers)."""
    data, edges = flat_bytes(texts)
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(np.ascontiguousarray(edges)), pa.py_buffer(np.ascontiguousarray(data)))


def runs(data: np.ndarray, edges: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Maximal runs of bytes of one kind inside each text: their starts, whether they are ``inside``
    ones, the runs themselves, and the text each belongs to."""
    n = len(data)
    cut = np.zeros(n + 1, dtype=bool)
    cut[1:n] = inside[1:] != inside[:-1]
    cut[edges] = True
    at = np.flatnonzero(cut)
    pieces = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data))
    return at[:-1], inside[at[:-1]], pieces, np.searchsorted(edges, at[:-1], side="right") - 1


def coded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(text index, word code) of every word in order, and the distinct words by code."""
    data, edges = flat_bytes(pc.utf8_lower(compact(texts)))
    if len(data) == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), []
    _, is_word, pieces, owner = runs(data, edges, _IN_WORD[data])
    coded = pc.dictionary_encode(pieces)
    codes = coded.indices.to_numpy(zero_copy_only=False)[is_word]
    return owner[is_word], codes, coded.dictionary.to_pylist()
