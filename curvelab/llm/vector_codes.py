"""Product codes of vectors by memoised grid cells (operator 13).

Components become integers ``floor(4096 * x)``; a vector is cut into ``parts`` consecutive parts,
each with a codebook of ``entries`` entries, learned by Lloyd rounds in exact integers.

*Memoised cells.*  The nearest entry of a part is found through a coarse grid: the part's cell is
looked up in a table of cells, which holds the entries that can be nearest somewhere in the
cell's box; only those are evaluated exactly.  A cell met for the first time is worked out
once: an entry is dominated if its least distance to the box exceeds another's greatest, or if
another is nearer at every point of the box (the difference of two squared distances is linear, so
its greatest value over a box is exact).  Ties are never dominated, so the result is that of
comparing all entries.  The table of a task is cleared beyond ``CELLS`` cells.

*Rounds.*  Every round is one pass over the written integer rows: tasks put out a count and a sum
for each entry they meet, Spark adds them, and the driver receives the sums (parts x entries
rows) and closes the codebook.  Nothing else passes through the driver.

Defined results: rows whose vector is null or holds null or non-finite components are dropped; a
null label is a label, a null vec_id sorts behind all others; rows repeat as often as in the
table; vectors of different length have codebooks of their own; where a length is no multiple of
``parts`` the first parts are one longer, parts without components have error 0; with fewer rows
than ``entries`` there are as many entries as rows; an empty table gives an empty table; other columns
are ignored.  Components whose squared distances could leave 64 bits are an error.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelab.llm.common import staged
from curvelab.session import bounded_broadcast

#: Cells that a task remembers for one part.
CELLS = 1 << 17

CODED = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"

Codebooks = list[list[list[int]]]  # part, entry, position


def part_edges(width: int, parts: int) -> list[int]:
    """Where the parts of a vector begin, and its end."""
    longer = width % parts
    return [k * (width // parts) + min(k, longer) for k in range(parts + 1)]


class Cells:
    """Nearest entries of one part through its remembered cells."""

    def __init__(self, book: list[list[int]], grid: tuple[np.ndarray, np.ndarray]):
        self.book = np.array(book, np.int64).reshape(len(book), -1)
        self.low, self.side = grid
        self.known: dict[bytes, bytes] = {}

    def candidates(self, cells: np.ndarray) -> np.ndarray:
        """(cells, entries): True where the entry is not dominated across the cell's box."""
        low = self.low + cells * self.side
        high = low + self.side - 1  # components are integers
        book = self.book
        near = np.maximum(np.maximum(low[:, None] - book, book - high[:, None]), 0)
        far = np.maximum(np.abs(book - low[:, None]), np.abs(book - high[:, None]))
        keep = (near * near).sum(axis=2) <= (far * far).sum(axis=2).min(axis=1)[:, None]
        # |x - k|^2 - |x - j|^2 is linear in x: its greatest value over the box is that of the middle and,
        # as all boxes have the same sides, an amount for each pair of entries
        middle = (low + high) @ book.T - (book * book).sum(axis=1)
        reach = (np.abs(book[:, None] - book) * (self.side - 1)).sum(axis=2)
        for k in range(len(book)):
            keep &= middle - middle[:, k : k + 1] + reach[k] >= 0
        return keep

    def _masks(self, cells: np.ndarray) -> np.ndarray:
        """The candidates of distinct cells, remembered ones not worked out again."""
        keys = [row.tobytes() for row in cells]
        new = [i for i, key in enumerate(keys) if key not in self.known]
        if len(self.known) + len(new) > CELLS:
            self.known.clear()
            new = list(range(len(keys)))
        step = max(1, (1 << 20) // (self.book.size + 1))
        for a in range(0, len(new), step):
            some = new[a : a + step]
            for i, mask in zip(some, np.packbits(self.candidates(cells[some]), axis=1)):
                self.known[keys[i]] = mask.tobytes()
        packed = np.frombuffer(b"".join([self.known[key] for key in keys]), np.uint8).reshape(len(keys), -1)
        return np.unpackbits(packed, axis=1, count=len(self.book)).astype(bool)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of every row; ties go to the lower entry."""
        n, count = len(x), len(self.book)
        if not x.shape[1]:
            return np.zeros(n, np.int64), np.zeros(n, np.int64)
        cells = (x - self.low) // self.side
        least = cells.min(axis=0)
        spans = [int(s) for s in cells.max(axis=0) - least + 1]
        total = 1
        for s in spans:
            total *= s
        if total < 2**62:
            # mixed radix: one integer a cell of this batch
            key = np.zeros(n, np.int64)
            for column, s in zip((cells - least).T, spans):
                key = key * s + column
            _, first, which = np.unique(key, return_index=True, return_inverse=True)
            distinct = cells[first]
        else:
            distinct, which = np.unique(cells, axis=0, return_inverse=True)
        allowed = self._masks(np.ascontiguousarray(distinct))[which.ravel()]
        row, entry = np.nonzero(allowed)
        gap = x[row] - self.book[entry]
        best = np.einsum("ij,ij->i", gap, gap) * count + entry
        best = np.minimum.reduceat(best, np.searchsorted(row, np.arange(n)))
        return best % count, best // count


def grids(books: Codebooks) -> list[tuple[np.ndarray, np.ndarray]]:
    """Origin and side lengths of each part's grid: half the spread of the starting entries."""
    out = []
    for book in books:
        b = np.array(book, np.int64).reshape(len(book), -1)
        spread = b.max(axis=0) - b.min(axis=0) if b.size else np.zeros(b.shape[1], np.int64)
        out.append((b.min(axis=0) if b.size else np.zeros(b.shape[1], np.int64), np.maximum(1, spread // 2)))
    return out


_WORKER: dict[str, list[Cells]] = {}


def _cells(books: Codebooks, grid) -> list[Cells]:
    """Kept by the Python worker as long as the codebooks stay."""
    key = digest(books)
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = [Cells(book, g) for book, g in zip(books, grid)]
    return _WORKER[key]


def digest(books: Codebooks) -> str:
    return hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()


def _matrix(column, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _slices(x: np.ndarray, entries: int):
    """Row slices that keep the work arrays of a part small."""
    step = max(1, (1 << 22) // max(1, x.shape[1] * entries // 8))
    return [slice(a, a + step) for a in range(0, len(x), step)]


def _sums(rows: DataFrame, books: Codebooks, grid, edges: list[int]) -> Codebooks:
    """The codebooks after one round."""
    width, sizes = edges[-1], [len(book) for book in books]

    def run(batches):
        tables = _cells(books, grid)
        count = [np.zeros(s, np.int64) for s in sizes]
        total = [np.zeros((s, b - a), np.int64) for s, a, b in zip(sizes, edges, edges[1:])]
        for batch in batches:
            x = _matrix(batch.column("v"), width)
            for part in _slices(x, max(sizes)):
                for p, (a, b) in enumerate(zip(edges, edges[1:])):
                    some = x[part, a:b]
                    code, _ = tables[p].nearest(some)
                    count[p] += np.bincount(code, minlength=sizes[p])
                    np.add.at(total[p], code, some)
        out = [(p, e, int(count[p][e]), total[p][e].tolist()) for p, s in enumerate(sizes) for e in range(s) if count[p][e]]
        names = ["part", "entry", "n", "total"]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    partial = rows.select("v").mapInArrow(run, "part int, entry int, n long, total array<long>")
    summed = (
        partial.select("part", "entry", "n", F.posexplode("total").alias("at", "sum"))
        .groupBy("part", "entry", "at")
        .agg(F.sum("n").alias("n"), F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum"))
    )
    out = [[list(entry) for entry in book] for book in books]
    for r in summed.collect():
        out[r["part"]][r["entry"]][r["at"]] = int(r["sum"]) // r["n"]
    return out


def _codes(rows: DataFrame, books: Codebooks, grid, edges: list[int]) -> DataFrame:
    """vec_id, label, code, error of every row."""
    width = edges[-1]
    hexadecimal = np.array([f"{e:02x}" for e in range(max(len(book) for book in books))])

    def run(batches):
        tables = _cells(books, grid)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = _matrix(batch.column("v"), width)
            code, error = [], np.zeros(len(x), np.int64)
            for p, (a, b) in enumerate(zip(edges, edges[1:])):
                found = [tables[p].nearest(x[part, a:b]) for part in _slices(x, len(books[p]))]
                code.append(hexadecimal[np.concatenate([f[0] for f in found])])
                error += np.concatenate([f[1] for f in found])
            text = ["".join(c) for c in zip(*(c.tolist() for c in code))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(text, pa.string()), pa.array(error)],
                names=["vec_id", "label", "code", "error"],
            )

    return rows.select("vec_id", "label", "v").mapInArrow(run, "vec_id long, label long, code string, error long")


def learn(rows: DataFrame, width: int, parts: int, entries: int, rounds: int) -> tuple[Codebooks, list]:
    """Codebooks of integer rows (vec_id, v) of one length, and the grids of their cells."""
    first = rows.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    edges = part_edges(width, parts)
    books = [[list(r["v"][a:b]) for r in first] for a, b in zip(edges, edges[1:])]
    grid = grids(books)
    for _ in range(rounds):
        books = _sums(rows, books, grid, edges)
    return books, grid


def product_codes(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6) -> DataFrame:
    """``CODED`` for the rows of ``vectors`` (vec_id, embedding, label)."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    v = F.col("embedding").cast("array<double>")
    rows = vectors.where(F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.transform(v, lambda x: F.floor(x * 4096.0)).alias("v"),
    )
    rows = staged(rows, "parts")
    widths = rows.groupBy(F.size("v")).agg(
        F.coalesce(F.greatest(F.max(F.array_max("v")), -F.min(F.array_min("v"))), F.lit(0))
    )
    coded = None
    for width, largest in sorted(tuple(r) for r in widths.collect()):
        if 4 * max(1, width) * (abs(largest) + 1) ** 2 * 2 * max(1, entries) >= 2**63:
            raise ValueError(f"components up to {largest} in {width} dimensions: squared distances may leave 64 bits")
        mine = rows.where(F.size("v") == width)
        books, grid = learn(mine, width, parts, entries, rounds)
        some = _codes(mine, books, grid, part_edges(width, parts)).withColumn("codebooks_sha256", F.lit(digest(books)))
        coded = some if coded is None else coded.union(some)
    if coded is None:
        return rows.sparkSession.createDataFrame([], CODED)
    coded = staged(coded, "codes")
    by_label = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    # a null label meets the null one
    by_label = bounded_broadcast(by_label, "label_errors")
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of_label")), "left").select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256"
    )
