"""Packing of documents into sequences of a fixed length (operator 2).

1.  Each document is tokenized once and cut at multiples of ``capacity``: pieces of
    ``capacity`` ids and one shorter tail.  Pieces are written with their ids, a length
    class (the length itself up to ``capacity / grain``, beyond that rounded up to ``grain``) and
    their rank among the class's pieces of the same partition.
2.  Pieces per class are counted: at most ``capacity / grain`` numbers of either kind, whatever the
    input.  Short pieces of one length go in bundles that fill whole grains (``grain`` pieces of an
    odd length), so a corpus of very short documents loses nothing by rounding; what is left of a
    length, less than a bundle, is rounded up.  ``cutting_stock.plan`` turns the histogram of
    bundles and pieces by grains into patterns and how often to use them.
3.  Ranked pieces take the patterns' places: base rank of the partition in the class
    (prefix sums over (class, partition) counts) plus own rank is the piece's rank; it gives the
    bundle, and the plan gives each bundle or piece its sequence and its slot.
4.  Inside a sequence (at most ``capacity`` pieces) slots are laid end to end.

Only the metadata of pieces is shuffled, never their ids; no step needs a class, however
large, in one task.

Defined results: null text is an empty text, which has its end id; each id of every row lies
in exactly one piece; repeated doc_ids and null doc_ids are packed like others; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curvelab.llm.common import staged, wide_input
from curvelab.llm.cutting_stock import plan
from curvelab.llm.pieces import pieces, small_batches

PIECES = (
    "part int, piece long, size int, rank long, doc_id long, start long, length long, doc_tokens long, width int, ids binary"
)


def cut_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, grain: int) -> DataFrame:
    """Step 1; ``ids`` are the piece's ids, unsigned little-endian integers of ``width`` bytes."""

    def run(batches):
        encoder = pieces(tokenizer)
        kind = np.dtype("<u2") if encoder.vocabulary_size <= 1 << 16 else np.dtype("<u4")
        part = TaskContext.get().partitionId()
        used = np.zeros(capacity + 1, np.int64)
        done = 0
        for batch in small_batches(batches, "text", 1 << 20):
            ids, offsets = encoder.encode(batch.column("text"), end_id)
            tokens = np.diff(offsets)
            count = -(-tokens // capacity)
            total = int(count.sum())
            row = np.repeat(np.arange(len(tokens)), count)
            number = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
            start = number * capacity
            length = np.minimum(capacity, tokens[row] - start)
            size = np.where(length <= capacity // grain, length, -(-length // grain) * grain)
            rank = np.empty(total, np.int64)
            order = np.argsort(size, kind="stable")
            values, first, each = np.unique(size[order], return_index=True, return_counts=True)
            rank[order] = np.arange(total) - np.repeat(first, each) + used[size[order]]
            used[values] += each
            raw = ids.astype(kind).tobytes()
            at = (offsets[row] + start) * kind.itemsize
            to = at + length * kind.itemsize
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(total, part, np.int32)),
                    pa.array(done + np.arange(total)),
                    pa.array(size.astype(np.int32)),
                    pa.array(rank),
                    batch.column("doc_id").take(pa.array(row)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(tokens[row]),
                    pa.array(np.full(total, kind.itemsize, np.int32)),
                    pa.array([raw[a:b] for a, b in zip(at.tolist(), to.tolist())], pa.binary()),
                ],
                names=["part", "piece", "size", "rank", "doc_id", "start", "length", "doc_tokens", "width", "ids"],
            )
            done += total

    return wide_input(docs, "doc_id", "text").mapInArrow(run, PIECES)


def bundles(demand: dict[int, int], capacity: int, grain: int) -> tuple[list[tuple], dict[int, int]]:
    """(ranges of ranks, units by grains).  A range is (size, from_rank, to_rank, grains, each, from_unit): every
    ``each`` pieces of this size from the rank on are one unit of so many grains, numbered from
    ``from_unit`` among the units of these grains."""
    ranges, units = [], {}

    def add(size: int, begin: int, end: int, grains: int, each: int) -> None:
        if end > begin:
            ranges.append((size, begin, end, grains, each, units.get(grains, 0)))
            units[grains] = units.get(grains, 0) + (end - begin) // each

    for size, n in sorted(demand.items()):
        each = grain // math.gcd(size, grain) if size <= capacity // grain else 1
        whole = n - n % each
        add(size, 0, whole, size * each // grain, each)
        add(size, whole, n, -(-size // grain), 1)
    return ranges, units


def _places(patterns: list[tuple[dict[int, int], int]]) -> list[tuple]:
    """(grains, from_unit, to_unit, sequence, per, slot): a unit of these grains whose number lies in
    the range goes to ``sequence + (unit - from_unit) div per``.  As many rows as the patterns have
    sizes, so at most a few thousand."""
    rows, taken, sequence = [], {}, 0
    for counts, times in patterns:
        slot = 0
        for grains, per in sorted(counts.items(), reverse=True):
            begin = taken.get(grains, 0)
            taken[grains] = begin + per * times
            rows.append((grains, begin, taken[grains], sequence, per, slot))
            slot += per
        sequence += times
    return rows


def place_pieces(cut: DataFrame, capacity: int, grain: int) -> DataFrame:
    """Steps 2 to 4: the pieces' columns but ids, with sequence_id, offset and sequence_tokens."""
    spark = cut.sparkSession
    counts = staged(cut.groupBy("part", "size").agg(F.count("*").alias("n")), "piece_counts")
    demand = {r["size"]: r["n"] for r in counts.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    ranges, units = bundles(demand, capacity, grain)
    ranges = spark.createDataFrame(
        ranges, "range_size int, from_rank long, to_rank long, grains int, each long, from_unit long"
    )
    places = spark.createDataFrame(
        _places(plan(units, capacity // grain)), "place_grains int, first long, last long, sequence long, per long, place long"
    )
    before = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "size", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = (
        cut.select("part", "piece", "size", "rank", "doc_id", "start", "length", "doc_tokens")
        .join(bases, ["part", "size"])
        .withColumn("rank", F.col("base") + F.col("rank"))
        .drop("base")
    )
    of_rank = (F.col("size") == F.col("range_size")) & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank"))
    bundled = ranked.join(F.broadcast(ranges), of_rank).withColumn("unit", F.expr("from_unit + (rank - from_rank) div each"))
    fits = (F.col("grains") == F.col("place_grains")) & (F.col("unit") >= F.col("first")) & (F.col("unit") < F.col("last"))
    put = bundled.join(F.broadcast(places), fits).select(
        "part",
        "piece",
        "doc_id",
        "start",
        "length",
        "doc_tokens",
        (F.col("sequence") + F.expr("(unit - first) div per")).alias("sequence_id"),
        F.struct((F.col("place") + F.expr("(unit - first) % per")), F.expr("(rank - from_rank) % each")).alias("slot"),
    )
    inside = Window.partitionBy("sequence_id")
    earlier = inside.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return put.select(
        "part",
        "piece",
        "doc_id",
        "start",
        "length",
        "doc_tokens",
        "sequence_id",
        F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset"),
        F.sum("length").over(inside).alias("sequence_tokens"),
    )


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 4096, grain: int = 16) -> tuple[DataFrame, DataFrame]:
    """(pieces with ids, placed pieces), both keyed by (part, piece).

    ``capacity`` must be a multiple of ``grain``.  Rounding up to ``grain`` costs half a grain
    a piece on average, and only pieces longer than ``capacity / grain``."""
    if capacity % grain:
        raise ValueError("capacity must be a multiple of grain")
    cut = staged(cut_documents(docs, tokenizer, end_id, capacity, grain), "pieces")
    return cut, place_pieces(cut, capacity, grain)


def piece_digests(cut: DataFrame) -> DataFrame:
    """(part, piece, ids_crc32): crc32 of each piece's ids as unsigned 32-bit integers."""
    import zlib

    def run(batches):
        for batch in batches:
            crc = [
                zlib.crc32(np.frombuffer(raw, f"<u{width}").astype("<u4"))
                for raw, width in zip(batch.column("ids").to_pylist(), batch.column("width").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("piece"), pa.array(crc, pa.int64())], names=["part", "piece", "ids_crc32"]
            )

    return cut.select("part", "piece", "width", "ids").mapInArrow(run, "part int, piece long, ids_crc32 long")
