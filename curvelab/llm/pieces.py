"""Token ids of whole texts through the ``tokenizers`` library, one call per distinct unit.

A unit is a stretch of text that the tokenizer's pre-tokenizer never looks beyond, so the
ids of a text are the ids of its units in order.  Texts are cut into units with numpy on
their UTF-8 bytes, the units of a batch are dictionary-coded by Arrow, each distinct one
goes through the library once, and the ids are gathered with numpy.

Only *plain* texts are cut: printable ASCII, tab, line feed, carriage return and the
Latin-1 letters, without ``<|`` (the start of special strings).  There the library's
character classes are certain.  Any other text is cut by the library: at its added tokens
(units of their own), and between them by its normalizer and pre-tokenizer.  Such a unit is
a pre-token in the model's alphabet, marked by ``_READY``, which no plain text holds.
Cuts in a plain text:

* between a letter or digit and ASCII punctuation other than the apostrophe (which
  may begin a contraction);
* ``spaces dropped`` (word-end vocabulary: white space separates, and is not encoded):
  where white space begins, so a word takes the white space before it along;
* ``spaces kept`` (byte-level vocabulary): where white space begins, before the last
  character of a longer run that a word follows, and after a last character that is
  no space (a single leading space belongs to its word).

A tokenizer file of another kind, or with added tokens that take their surroundings
along, gets whole texts as units.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHED_UNITS = 600_000
#: Bytes of cached units and their ids.
CACHED_BYTES = 64 << 20

_READY = "\ue000"

_OTHER, _WORD, _MARK, _SPACE, _QUOTE, _LEAD = range(6)


def _byte_classes() -> np.ndarray:
    kind = np.full(256, _OTHER, np.uint8)
    for c in range(0x21, 0x7F):
        kind[c] = _WORD if chr(c).isalnum() else _MARK
    kind[ord("'")] = _QUOTE
    kind[list(b" \t\n\r")] = _SPACE
    kind[0xC3] = _LEAD
    return kind


_KIND = _byte_classes()
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = re.escape("".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum() and c != 0x27))
#: Units that are exactly one pre-token, by cut rule.
_ONE_TOKEN = {
    "spaces dropped": re.compile(rf"[{_LETTER}]+|[0-9]|[{_MARKS}]+"),
    "spaces kept": re.compile(rf" ?[{_LETTER}]+| ?[0-9]+| ?[{_MARKS}]+|[ \t\n\r]+"),
}


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _cut_rule(spec: dict) -> str:
    pre = spec.get("pre_tokenizer") or {}
    steps = pre.get("pretokenizers", [pre])
    first = steps[0] if steps else {}
    around = ("single_word", "lstrip", "rstrip", "normalized")
    if any(t.get(k) for t in spec.get("added_tokens") or [] for k in around):
        return "whole"
    if first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert"):
        return "spaces dropped"
    plain = first.get("type") == "ByteLevel" and first.get("use_regex") and not first.get("add_prefix_space")
    if len(steps) == 1 and plain and spec.get("normalizer") is None:
        return "spaces kept"
    return "whole"


def _lowers(spec: dict) -> bool:
    norm = spec.get("normalizer") or {}
    return any(n.get("type") == "Lowercase" for n in norm.get("normalizers", [norm]))


def _byte_symbols() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest for
    characters from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in own}
    rest = [b for b in range(256) if b not in table]
    return table | {b: chr(256 + i) for i, b in enumerate(rest)}


class Pieces:
    """Encoder of one tokenizer file.  Holds about ``CACHED_UNITS`` units and ``CACHED_BYTES`` between
    batches; a batch's own units are held whatever their size."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.rule, self.lowers = _cut_rule(spec), _lowers(spec)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.vocabulary_size = self.library.get_vocab_size(with_added_tokens=True)
        self.one_token = _ONE_TOKEN.get(self.rule)
        self.symbols = _byte_symbols()
        added = sorted((t["content"] for t in spec.get("added_tokens") or []), key=len, reverse=True)
        self.added = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self._forget()

    def _forget(self) -> None:
        self.codes: dict[str, int] = {}
        self.held = 0
        self.starts = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)

    def _pre_tokens(self, text: str) -> list[str]:
        """Units of a text that is not plain."""
        if self.rule == "whole":
            return [text]
        normalizer, out = self.library.normalizer, []
        for k, part in enumerate(self.added.split(text) if self.added else [text]):
            if k % 2:
                out.append(part)
            elif part:
                part = normalizer.normalize_str(part) if normalizer else part
                out.extend(_READY + piece for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(part))
        return out

    def units(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Units of all texts in order, and ``len(texts) + 1`` offsets into them."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        special = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        begin, end = int(bounds[0]), int(bounds[-1])
        data = np.frombuffer(texts.buffers()[2], np.uint8)[begin:end] if end > begin else np.empty(0, np.uint8)
        if self.lowers and not special.any():
            capital = (data >= 0x41) & (data <= 0x5A)
            data = data | (capital.view(np.uint8) << np.uint8(5))
        edges = bounds - begin
        n = len(data)
        cut = np.zeros(n + 1, dtype=bool)
        plain = np.full(len(texts), self.rule == "whole")
        if self.rule != "whole" and n:
            kind = _KIND[data]
            lead = np.flatnonzero(kind == _LEAD)
            kind[lead] = _WORD
            follow = np.minimum(lead + 1, n - 1)
            sign = (data[follow] == 0x97) | (data[follow] == 0xB7)
            kind[follow[~sign]] = _WORD
            plain = ~special
            plain[np.searchsorted(edges, np.flatnonzero(kind == _OTHER), side="right") - 1] = False
            space = kind == _SPACE
            word, mark = kind == _WORD, kind == _MARK
            cut[1:n] = (word[:-1] & mark[1:]) | (mark[:-1] & word[1:])
            cut[1:n] |= space[1:] & ~space[:-1]
            if self.rule == "spaces kept":
                last = space[:-1] & ~space[1:]  # the last of a run, a word follows
                cut[1 : n - 1] |= space[:-2] & last[1:]
                cut[1:n] |= last & (data[:-1] != 0x20)
            if not plain.all():
                for i in np.flatnonzero(~plain):
                    cut[edges[i] : edges[i + 1]] = False
        # an empty text needs no unit: its offsets are equal
        cut[edges] = True
        at = np.flatnonzero(cut)
        if n == 0:
            return pa.array([], pa.large_string()), np.zeros(len(texts) + 1, np.int64)
        units = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data))
        bounds = np.searchsorted(at, edges)
        if plain.all():
            return units, bounds
        parts, counts, done = [], np.diff(bounds), 0
        for i in np.flatnonzero(~plain & (counts > 0)).tolist():
            own = self._pre_tokens(texts[i].as_py())
            parts += [units.slice(done, int(bounds[i]) - done), pa.array(own, pa.large_string())]
            done, counts[i] = int(bounds[i + 1]), len(own)
        parts.append(units.slice(done))
        return pa.concat_arrays(parts), np.concatenate([[0], np.cumsum(counts)])

    def _one(self, unit: str) -> str | None:
        """The unit in the model's alphabet if it is one pre-token, else None."""
        if self.rule == "spaces dropped":
            unit = unit.lstrip(" \t\n\r")
        if self.one_token is None or not self.one_token.fullmatch(unit):
            return None
        if self.lowers:
            unit = unit.lower()
        if unit.isascii() and " " not in unit and unit.isprintable():
            return unit
        return unit.encode().decode("latin-1").translate(self.symbols)

    def encode_units(self, units: list[str]) -> list[list[int]]:
        tokenize = self.library.model.tokenize
        out: list = [None] * len(units)
        rest = []
        for i, u in enumerate(units):
            own = u[1:] if u.startswith(_READY) and self.rule != "whole" else self._one(u)
            if own is None:
                rest.append(i)
            else:
                out[i] = [t.id for t in tokenize(own)]
        if rest:
            got = self.library.encode_batch([units[i] for i in rest], add_special_tokens=False)
            for i, e in zip(rest, got):
                out[i] = e.ids
        return out

    def _learn(self, units: list[str]) -> np.ndarray:
        new = [u for u in units if u not in self.codes]
        if new:
            size = sum(map(len, new))
            if self.codes and (len(self.codes) + len(new) > CACHED_UNITS or self.held + size > CACHED_BYTES):
                self._forget()
                new = units
            codes = self.codes
            got = self.encode_units(new)
            lengths = np.fromiter(map(len, got), np.int64, len(got))
            starts = len(self.ids) + np.cumsum(lengths) - lengths
            flat = np.fromiter((i for x in got for i in x), np.uint32, int(lengths.sum()))
            codes.update(zip(new, range(len(codes), len(codes) + len(new))))
            self.starts = np.concatenate([self.starts, starts])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.ids = np.concatenate([self.ids, flat])
            self.held += sum(map(len, new)) + flat.nbytes
        return np.fromiter(map(self.codes.__getitem__, units), np.int64, len(units))

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) of a batch of texts, and ``len(texts) + 1`` offsets.
        ``end_id`` is appended to every text."""
        units, bounds = self.units(texts)
        coded = pc.dictionary_encode(units)
        codes = self._learn(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
        lengths = self.lengths[codes]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        texts_ends = ends[bounds]
        total = int(ends[-1])
        source = np.repeat(self.starts[codes] - ends[:-1], lengths)
        source += np.arange(total)
        flat = self.ids[source]
        if end_id is None:
            return flat, texts_ends
        offsets = texts_ends + np.arange(len(texts_ends))
        return np.insert(flat, texts_ends[1:], end_id).astype(np.uint32, copy=False), offsets


_OPEN: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The encoder of a file, opened once per Python worker."""
    if path not in _OPEN:
        _OPEN[path] = Pieces(path)
    return _OPEN[path]


def small_batches(batches, column: str, budget: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``budget`` bytes of text; a longer text is a batch of its own."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if total and total + n > budget:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        yield batch.slice(start)
