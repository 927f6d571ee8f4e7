"""Benchmark passages in documents, edited ones included (operator 5).

Texts are compared lower-cased with white space collapsed to one space.  An item of n
characters may differ from the passage by ``errors(n)`` edits (characters inserted, deleted
or exchanged).

*Pigeonhole.*  An item is cut into errors + 1 pieces.  A passage within that many edits
leaves at least one piece untouched, so an exact search for all pieces of all items (one
Aho-Corasick automaton) finds every passage.  *Verification.*  Around each hit Myers'
bit-parallel algorithm computes the edit distance of the whole item to the best passage; the
windows of an item that overlap are one window, so no character is compared twice with it.

The error budget leaves pieces of at least ``piece_chars`` characters.  Items too short for
two pieces must be met exactly, between word boundaries.

The items are written to the shared folder as a table, dealt by hash to groups of about
``group_chars`` characters and sorted by group.  The documents are read once: a task gathers
rows up to ``buffer_bytes``, reads the items from the folder, and searches the gathered rows for one group
after another.  A benchmark of one group stays in the task's memory.  The driver learns the number
of characters only.

Defined results: null or blank texts and items match nothing; repeated items match each;
an item with a null id is reported with a null id; repeated documents give a row each; empty
tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelab.llm.common import staged, wide_input
from curvelab.operators.shared_rows import SharedRows, part_files

MATCHES = "doc_id long, item_id long, distance int, match_end long, item_chars int"


def plain(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def errors(n: int, piece_chars: int) -> int:
    """Edits that an item of ``n`` characters may have: its pieces keep ``piece_chars`` characters."""
    return max(0, n // piece_chars - 1)


def cut(item: str, parts: int) -> list[tuple[int, str]]:
    """``parts`` pieces of nearly equal length, with their positions."""
    n = len(item)
    at = [n * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(at, at[1:])]


class Myers:
    """Edit distance of one item to the best passage of a text (Myers' bit vectors in one integer)."""

    def __init__(self, item: str):
        self.length = len(item)
        self.mask = (1 << self.length) - 1
        self.high = 1 << (self.length - 1)
        self.where: dict[str, int] = {}
        for i, c in enumerate(item):
            self.where[c] = self.where.get(c, 0) | 1 << i

    def best(self, text: str) -> tuple[int, int]:
        """(smallest distance, end of the first passage that has it)."""
        plus, minus, score = self.mask, 0, self.length
        best, end, mask, high, where = score, 0, self.mask, self.high, self.where
        for i, c in enumerate(text, 1):
            same = where.get(c, 0)
            vertical = same | minus
            horizontal = (((same & plus) + plus) ^ plus) | same
            up = minus | ~(horizontal | plus)
            down = plus & horizontal
            if up & high:
                score += 1
            elif down & high:
                score -= 1
                if score < best:
                    best, end = score, i
            up <<= 1
            plus = ((down << 1) | ~(vertical | up)) & mask
            minus = up & vertical & mask
        return best, end


class Finder:
    """All items of a group, searched for at once."""

    def __init__(self, items: list[tuple[int | None, str]], piece_chars: int):
        import ahocorasick

        self.items = [(i, plain(t)) for i, t in items]
        self.items = [(i, t) for i, t in self.items if t]
        self.budget = [errors(len(t), piece_chars) for _, t in self.items]
        self.myers: dict[int, Myers] = {}
        found: dict[str, list[tuple[int, int]]] = {}
        for k, (_, text) in enumerate(self.items):
            for at, piece in cut(text, self.budget[k] + 1):
                found.setdefault(piece, []).append((k, at))
        self.search = ahocorasick.Automaton()
        for piece, where in found.items():
            self.search.add_word(piece, (len(piece), where))
        if found:
            self.search.make_automaton()
        self.empty = not found

    def matches(self, text: str) -> list[tuple[int | None, int, int, int]]:
        """(item id, distance, end of the passage in the plain text, item length), the best passage of each item."""
        if self.empty or not text:
            return []
        best: dict[int, tuple[int, int]] = {}
        windows: dict[int, list[list[int]]] = {}
        for last, (size, where) in self.search.iter(text):
            for k, at in where:
                if k in best:
                    continue
                item, budget = self.items[k][1], self.budget[k]
                n, start = len(item), last + 1 - size - at
                if at == 0 and text.startswith(item, start):
                    end = start + n
                    ends = (start == 0 or not text[start - 1].isalnum()) and (end == len(text) or not text[end].isalnum())
                    if budget or n >= 32 or ends:
                        best[k] = (0, end)
                        continue
                if budget == 0:
                    continue
                lo, hi = max(0, start - budget), min(len(text), start + n + budget)
                if hi - lo < n - budget:
                    continue
                found = windows.setdefault(k, [])
                while found and found[-1][0] <= hi and lo <= found[-1][1]:
                    before = found.pop()
                    lo, hi = min(lo, before[0]), max(hi, before[1])
                found.append([lo, hi])
        for k, found in windows.items():
            if k in best:
                continue
            if k not in self.myers:
                self.myers[k] = Myers(self.items[k][1])
            myers = self.myers[k]
            for lo, hi in sorted(found):
                distance, end = myers.best(text[lo:hi])
                if distance <= self.budget[k] and distance < best.get(k, (distance + 1,))[0]:
                    best[k] = (distance, lo + end)
        return [(self.items[k][0], d, e, len(self.items[k][1])) for k, (d, e) in sorted(best.items())]


class Items:
    """The written items, group after group; the finder of a single group is kept by the Python worker."""

    kept: dict[tuple, Finder] = {}

    def __init__(self, files: list[str], groups: int, piece_chars: int):
        self.files, self.groups, self.piece_chars = files, groups, piece_chars

    def finders(self) -> Iterator[Finder]:
        key = (tuple(self.files), self.piece_chars)
        if key in Items.kept:
            yield Items.kept[key]
            return
        group, items = None, []
        for batch in SharedRows(self.files, ["item_id", "text", "item_group"], 1024, keep_bytes=0):
            for item, text, g in zip(*(batch.column(c).to_pylist() for c in ("item_id", "text", "item_group"))):
                if items and g != group:
                    yield Finder(items, self.piece_chars)
                    items = []
                group = g
                items.append((item, text))
        if items:
            finder = Finder(items, self.piece_chars)
            if self.groups == 1:
                Items.kept.clear()
                Items.kept[key] = finder
            yield finder


def written_items(benchmark: DataFrame, group_chars: int, piece_chars: int) -> Items | None:
    """The distinct items that are not blank, in groups of about ``group_chars`` characters (None without any)."""
    rows = benchmark.select("item_id", "text").where(F.length(F.trim("text")) > 0).distinct()
    chars = rows.agg(F.sum(F.length("text").cast("long"))).first()[0]
    if not chars:
        return None
    groups = -(-chars // group_chars)
    dealt = rows.withColumn("item_group", F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)))
    # files in order of their groups
    parts = max(1, min(groups, -(-chars // (64 << 20))))
    ordered = dealt.repartitionByRange(parts, "item_group").sortWithinPartitions("item_group", "item_id", "text")
    return Items(part_files(staged(ordered, "items")), groups, piece_chars)


def _gathered(batches, budget: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches together, of about ``budget`` bytes."""
    some, size = [], 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        some.append(batch)
        size += batch.nbytes
        if size >= budget:
            yield some
            some, size = [], 0
    if some:
        yield some


def find_passages(
    docs: DataFrame, benchmark: DataFrame, piece_chars: int = 12, group_chars: int = 4 << 20, buffer_bytes: int = 32 << 20
) -> DataFrame:
    """One row per document and benchmark item that it holds: doc_id, item_id, distance (edits of the
    best passage), match_end (where it ends in the plain text), item_chars."""
    slim = wide_input(docs, "doc_id", "text")
    items = written_items(benchmark, group_chars, piece_chars)
    if items is None:
        return slim.sparkSession.createDataFrame([], MATCHES)

    def run(batches):
        for some in _gathered(batches, buffer_bytes):
            for finder in items.finders():
                out = [
                    (doc, item, distance, end, n)
                    for batch in some
                    for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"))
                    for item, distance, end, n in finder.matches(plain(text.as_py()))
                ]
                columns = list(zip(*out)) or [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["doc_id", "item_id", "distance", "match_end", "item_chars"],
                )

    return slim.mapInArrow(run, MATCHES)


def keep_uncontaminated(
    docs: DataFrame, benchmark: DataFrame, piece_chars: int = 12, group_chars: int = 4 << 20, buffer_bytes: int = 32 << 20
) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns as they are."""
    items = written_items(benchmark, group_chars, piece_chars)
    if items is None:
        return docs
    names = docs.columns

    def run(batches):
        for some in _gathered(batches, buffer_bytes):
            for finder in items.finders():
                clean = [[not finder.matches(plain(t.as_py())) for t in batch.column("text")] for batch in some]
                some = [batch.filter(pa.array(c, pa.bool_())) for batch, c in zip(some, clean)]
            yield from (batch.select(names) for batch in some)

    return docs.mapInArrow(run, docs.schema)
