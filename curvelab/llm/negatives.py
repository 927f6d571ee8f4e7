"""Hard negatives by Four-Russians scoring (operator 12).

Components become integers ``floor(256 * x)``; a score is the exact integer inner product of an
anchor and a candidate.

1.  *Index.*  Every candidate is written once as its packed bit planes: plane p holds bit p of
    every component (two's complement, the top plane counts negative), eight components a byte.
    The number of planes follows from the largest component of the table.
2.  *Tables.*  For every anchor and every group of eight dimensions, the 256 sums of the subsets
    of the anchor's eight components.  One lookup by a candidate's byte adds eight products of
    a plane; doubling the running sum and adding the next plane gives the full score.
    No multiplication takes place.
3.  *Positives.*  Blocks of anchors meet slices of the index; each cell of blocks and slices keeps
    the best ``positives`` rows of the anchor's label, cells are merged by rank.
4.  *Negatives.*  The same cells once more: for each positive, the best ``negatives`` rows of
    other labels whose score lies in its window.

A block holds at most about ``block_rows`` anchors and a slice about ``slice_rows`` candidates, so
a task's memory and time are bounded and a lost one is cheap to repeat; more rows make more cells.
Anchors are copied once per slice, candidates never.  A cell puts out at most ``positives`` (then
``positives * negatives``) rows an anchor whatever the labels' sizes.

Defined results: rows whose vec_id, label or vector is null, or whose vector holds null or
non-finite components, take no part; vectors of different length never meet, empty ones score 0;
rows are told apart by position only, so repeated rows each count, and each anchor row gives its
own result; an anchor's positives have another vec_id than the anchor; a positive with a negative
score has an empty window; an empty table gives an empty table; other columns are ignored.
Components so large that 100 times a score could leave 64 bits are an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curvelab.llm.common import staged
from curvelab.operators.shared_rows import SharedRows, part_files

MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"

#: Anchors scored at once and candidates in a chunk: their tables and sums stay in a core's cache.
TOGETHER, CHUNK = 64, 512


def planes_of(values: np.ndarray, planes: int) -> np.ndarray:
    """Packed bit planes (rows, planes, groups of eight dimensions) of integer rows."""
    n, d = values.shape
    groups = -(-d // 8)
    out = np.empty((n, planes, groups), np.uint8)
    for p in range(planes):
        out[:, p] = np.packbits(((values >> p) & 1).astype(np.uint8), axis=1, bitorder="little")
    return out


def subset_sums(anchors: np.ndarray, dtype) -> np.ndarray:
    """(groups, 256, anchors): the sums of all subsets of each eight components."""
    n, d = anchors.shape
    groups = -(-d // 8)
    padded = np.zeros((n, 8 * groups), np.int64)
    padded[:, :d] = anchors
    out = np.zeros((groups, 256, n), dtype)
    for g in range(groups):
        for j in range(8):
            out[g, 1 << j : 2 << j] = out[g, : 1 << j] + padded[:, 8 * g + j].astype(dtype)
    return out


class Scorer:
    """Exact scores of up to ``TOGETHER`` anchors against packed candidates."""

    def __init__(self, anchors: np.ndarray, largest: int):
        d = anchors.shape[1]
        # the narrowest integers that hold a plane's sum and a whole score
        small = next(t for t in (np.int16, np.int32, np.int64) if d * (largest + 1) <= np.iinfo(t).max)
        self.total = next(t for t in (np.int32, np.int64) if 2 * d * (largest + 1) ** 2 <= np.iinfo(t).max)
        self.tables = subset_sums(anchors, small)

    def scores(self, packed: np.ndarray) -> np.ndarray:
        """(candidates, anchors)."""
        groups, _, n = self.tables.shape
        rows, planes, _ = packed.shape
        total = np.zeros((rows, n), self.total)
        if not groups:
            return total
        plane, part = np.empty((rows, n), self.tables.dtype), np.empty((rows, n), self.tables.dtype)
        for p in range(planes - 1, -1, -1):
            np.take(self.tables[0], packed[:, p, 0], axis=0, out=plane)
            for g in range(1, groups):
                np.take(self.tables[g], packed[:, p, g], axis=0, out=part)
                plane += part
            if p == planes - 1:
                total -= plane
            else:
                total <<= 1
                total += plane
        return total


def best_rows(owner: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the first ``k`` rows of each owner, higher scores first, then smaller ids."""
    order = np.lexsort((ident, -score, owner))
    sorted_owner = owner[order]
    first = np.flatnonzero(np.diff(sorted_owner, prepend=-1))
    place = np.arange(len(order)) - np.repeat(first, np.diff(first, append=len(order)))
    return order[place < k]


class Index:
    """The packed candidates of one slice, read in batches from the shared folder."""

    def __init__(self, files: list[str], planes: int, groups: int, batch_rows: int = 65_536):
        self.rows = SharedRows(files, ["vec_id", "label", "packed"], batch_rows, keep_bytes=0)
        self.shape = (planes, groups)

    def __iter__(self):
        for batch in self.rows:
            # Parquet batches of one width: the values lie one after the other
            packed = np.frombuffer(b"".join(batch.column("packed").to_pylist()), np.uint8)
            yield (
                batch.column("vec_id").to_numpy(zero_copy_only=False),
                batch.column("label").to_numpy(zero_copy_only=False),
                packed.reshape(batch.num_rows, *self.shape),
            )


def _matrix(column, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


class Nearest:
    """The best ``k`` rows of each anchor's label so far."""

    def __init__(self, ids: np.ndarray, label: int, scorer: Scorer, k: int):
        self.ids, self.label, self.scorer, self.k = ids, label, scorer, k
        self.floor = np.full(len(ids), np.iinfo(np.int64).min)
        self.kept = tuple(np.empty(0, np.int64) for _ in range(3))

    def meet(self, ids: np.ndarray, labels: np.ndarray, packed: np.ndarray) -> None:
        same = np.flatnonzero(labels == self.label)
        for start in range(0, len(same), CHUNK):
            some = same[start : start + CHUNK]
            scores = self.scorer.scores(packed[some])
            row, owner = np.nonzero((scores >= self.floor) & (ids[some][:, None] != self.ids))
            new = owner, scores[row, owner].astype(np.int64), ids[some][row]
            self.kept = tuple(np.concatenate(pair) for pair in zip(self.kept, new))
            if len(self.kept[0]) > 4 * self.k * len(self.ids):
                self.prune()

    def prune(self) -> None:
        best = best_rows(*self.kept, self.k)
        self.kept = tuple(part[best] for part in self.kept)
        full = np.bincount(self.kept[0], minlength=len(self.ids)) == self.k
        lowest = np.full(len(self.ids), np.iinfo(np.int64).max)
        np.minimum.at(lowest, self.kept[0], self.kept[1])
        self.floor[full] = lowest[full]


class Windows:
    """The best ``k`` rows of other labels so far, for each window of each anchor."""

    def __init__(self, labels: np.ndarray, windows: list[list[int]], scorer: Scorer, k: int):
        self.labels, self.scorer, self.k = labels, scorer, k
        most = max(len(w) for w in windows)
        # a window that is none lies above every score
        top = np.full((len(windows), most), -1, np.int64)
        for i, w in enumerate(windows):
            top[i, : len(w)] = w
        self.top = top
        self.low = np.where(top >= 0, -(-80 * top // 100), np.iinfo(np.int64).max)
        self.floor, self.ceiling = self.low.min(axis=1), self.top.max(axis=1)
        self.kept = tuple(np.empty(0, np.int64) for _ in range(3))

    def meet(self, ids: np.ndarray, labels: np.ndarray, packed: np.ndarray) -> None:
        for start in range(0, len(ids), CHUNK):
            part = slice(start, start + CHUNK)
            scores = self.scorer.scores(packed[part])
            row, owner = np.nonzero((scores >= self.floor) & (scores <= self.ceiling))
            other = labels[part][row] != self.labels[owner]
            row, owner = row[other], owner[other]
            new = owner, scores[row, owner].astype(np.int64), ids[part][row]
            self.kept = tuple(np.concatenate(pair) for pair in zip(self.kept, new))
            if len(self.kept[0]) > 8 * self.k * self.top.size:
                some = np.unique(np.concatenate([at for _, at in self.by_window()]))
                self.kept = tuple(part[some] for part in self.kept)

    def by_window(self):
        """(window number, indexes of the rows kept for it)."""
        owner, score, _ = self.kept
        for w in range(self.top.shape[1]):
            inside = np.flatnonzero((score >= self.low[owner, w]) & (score <= self.top[owner, w]))
            yield w, inside[best_rows(*(part[inside] for part in self.kept), self.k)]


def _runs(labels: np.ndarray):
    """Slices of equal labels, at most ``TOGETHER`` long, of sorted labels."""
    edges = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(labels)]
    for a, b in zip(edges, edges[1:]):
        for start in range(a, b, TOGETHER):
            yield slice(start, min(b, start + TOGETHER))


FOUND = pa.schema([("anchor", pa.int64()), ("window", pa.int32()), ("found_id", pa.int64()), ("score", pa.int64())])
FOUND_SQL = "anchor long, window int, found_id long, score long"


def _found(parts: list[tuple]) -> pa.Table:
    columns = [np.concatenate(c) for c in zip(*parts)] if parts else [[]] * 4
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FOUND)], schema=FOUND)


def _cells(anchors: DataFrame, blocks: int, slices: int, work) -> DataFrame:
    """``work(anchor rows, slice number)`` for every block of anchors and slice of the index."""
    rows = anchors.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    # as many tasks as cells: a cell is long work on few rows, which sizes in bytes do not show
    cells = rows.repartition(max(1, blocks * slices), "block", "slice").groupBy("block", "slice")
    return cells.applyInArrow(lambda table: work(table, table.column("slice")[0].as_py()), FOUND_SQL)


def _mine(rows: DataFrame, width: int, least: int, most: int, n: int, n_anchors: int, options) -> DataFrame:
    """The result for the vectors of one length; ``least`` and ``most`` bound their components."""
    anchor_step, positives, negatives, block_rows, slice_rows = options
    largest = max(-least, most, 1)
    if 2 * 100 * max(1, width) * (largest + 1) ** 2 >= 2**63:
        raise ValueError(f"components up to {largest} in {width} dimensions: 100 times a score may leave 64 bits")
    planes, groups = largest.bit_length() + 1, -(-width // 8)

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                packed = planes_of(_matrix(batch.column("v"), width), planes).reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("label"), pa.array([r.tobytes() for r in packed], pa.binary())],
                    names=["vec_id", "label", "packed"],
                )

    index = staged(rows.mapInArrow(pack, "vec_id long, label long, packed binary"), "planes")
    files = part_files(index)
    slices = min(len(files), -(-n // slice_rows))
    cores = rows.sparkSession.sparkContext.defaultParallelism
    blocks = max(-(-n_anchors // block_rows), min(4 * cores, -(-n_anchors // TOGETHER)))
    # blocks hold neighbouring labels; the vec_id splits a label with very many anchors
    chosen = rows.where(F.col("vec_id") % anchor_step == 0).repartitionByRange(blocks, "label", "vec_id")
    anchors = staged(
        chosen.select(F.monotonically_increasing_id().alias("anchor"), F.spark_partition_id().alias("block"), "vec_id", "label", "v"),
        "anchors",
    )

    def sorted_block(table: pa.Table):
        table = table.sort_by([("label", "ascending"), ("anchor", "ascending")])
        columns = [table.column(c).to_numpy() for c in ("anchor", "vec_id", "label")]
        return table, *columns, _matrix(table.column("v"), width)

    def nearest(table: pa.Table, number: int) -> pa.Table:
        _, anchor, ids, labels, v = sorted_block(table)
        work = [(part, Nearest(ids[part], labels[part][0], Scorer(v[part], largest), positives)) for part in _runs(labels)]
        for batch in Index(files[number::slices], planes, groups):
            for _, some in work:
                some.meet(*batch)
        out = []
        for part, some in work:
            some.prune()
            owner, score, found = some.kept
            out.append((anchor[part][owner], np.zeros(len(owner)), found, score))
        return _found(out)

    def windows(table: pa.Table, number: int) -> pa.Table:
        table, anchor, _, labels, v = sorted_block(table)
        tops = table.column("tops").to_pylist()
        parts = [slice(a, a + TOGETHER) for a in range(0, len(anchor), TOGETHER)]
        work = [(part, Windows(labels[part], tops[part], Scorer(v[part], largest), negatives)) for part in parts]
        for batch in Index(files[number::slices], planes, groups):
            for _, some in work:
                some.meet(*batch)
        out = []
        for part, some in work:
            for w, at in some.by_window():
                owner, score, found = (c[at] for c in some.kept)
                out.append((anchor[part][owner], np.full(len(at), w), found, score))
        return _found(out)

    def ranked(found: DataFrame, k: int) -> DataFrame:
        order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "found_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    first = staged(ranked(_cells(anchors, blocks, slices, nearest), positives), "positives")
    tops = first.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("s"))
    second = anchors.join(tops.select("anchor", F.col("s.score").alias("tops")), "anchor")
    found = ranked(_cells(second, blocks, slices, windows), negatives)
    pairs = first.select(
        "anchor", (F.col("rank") - 1).alias("window"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    names = anchors.select("anchor", F.col("vec_id").alias("anchor_id"))
    return (
        found.join(pairs, ["anchor", "window"])
        .join(names, "anchor")
        .select(
            "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
    )


def hard_negatives(
    vectors: DataFrame,
    anchor_step: int = 100,
    positives: int = 5,
    negatives: int = 5,
    block_rows: int = 1024,
    slice_rows: int = 16_000_000,
) -> DataFrame:
    """``MINED`` for the anchors (vec_id divisible by ``anchor_step``) of ``vectors`` (vec_id, embedding,
    label): their first ``positives`` rows of the same label, and for each the first ``negatives``
    rows of other labels whose score is 0.8 to 1 times the positive's."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.transform(v, lambda x: F.floor(x * 256.0)).alias("v"),
    )
    of_length = rows.groupBy(F.size("v").alias("width")).agg(
        F.coalesce(F.min(F.array_min("v")), F.lit(0)),
        F.coalesce(F.max(F.array_max("v")), F.lit(0)),
        F.count("*"),
        F.count(F.when(F.col("vec_id") % anchor_step == 0, 1)),
    )
    out = rows.sparkSession.createDataFrame([], MINED)
    for width, least, most, n, n_anchors in sorted(tuple(r) for r in of_length.collect()):
        if n_anchors:
            mine = rows.where(F.size("v") == width)
            options = anchor_step, positives, negatives, block_rows, slice_rows
            out = out.union(_mine(mine, width, least, most, n, n_anchors, options))
    return out
