"""Token counts of whole texts without ids (operator 3).

A *pre-token* is a unit of ``pieces``: a stretch the tokenizer never looks beyond.

1.  Texts are cut into chunks of about ``chunk_bytes``.  A chunk keeps its distinct
    pre-tokens once, and per document the codes and frequencies of its pre-tokens.
2.  The chunks' pre-tokens are shuffled by their text, so that every distinct pre-token
    meets the tokenizer in one task and its pieces are counted there once.  A word that
    every document holds is one row per chunk.
3.  The counts return to their chunk, are joined to the documents' frequencies and summed.

What is shuffled are distinct pre-tokens and compressed frequencies; ids exist nowhere.
A chunk is bounded by ``chunk_bytes`` or by one document, so are all groups.

Defined results: null text counts as empty (0 bytes, 0 tokens); every input row gives one
row, repeated doc_ids and null doc_ids too; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelab.llm.common import staged, wide_input
from curvelab.llm.pieces import pieces, small_batches

CHUNKS = "chunk long, doc_id array<long>, n_bytes array<long>, ends array<long>, codes binary, freqs binary, units array<string>"


def _pack(values: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(values, "<u4").tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(blob: bytes) -> np.ndarray:
    size = int.from_bytes(blob[:8], "little")
    return np.frombuffer(pa.decompress(blob[8:], size, codec="zstd"), "<u4")


def _one_list(values: pa.Array) -> pa.Array:
    """A list column of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def chunked_frequencies(docs: DataFrame, tokenizer: str, chunk_bytes: int) -> DataFrame:
    """Step 1: one row a chunk (see ``CHUNKS``); ``codes`` holds each document's sorted codes as
    differences, ``ends`` where each document's codes end."""

    def run(batches):
        encoder = pieces(tokenizer)
        base = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(small_batches(batches, "text", chunk_bytes)):
            texts = batch.column("text")
            # cut in small steps: what cutting needs beside the units stays small
            parts, bounds = [], [np.zeros(1, np.int64)]
            for some in small_batches([batch.select(["text"])], "text"):
                units, ends = encoder.units(some.column("text"))
                parts.append(units)
                bounds.append(ends[1:] + bounds[-1][-1])
            coded = pa.chunked_array(parts, pa.large_string()).dictionary_encode().unify_dictionaries()
            dictionary = coded.chunk(0).dictionary if coded.num_chunks else pa.array([], pa.large_string())
            width = max(1, len(dictionary))
            keys = np.repeat(np.arange(len(texts)) * width, np.diff(np.concatenate(bounds)))
            at = 0
            for part in coded.chunks:
                keys[at : at + len(part)] += part.indices.to_numpy(zero_copy_only=False)
                at += len(part)
            del parts, coded
            keys.sort()
            new = np.flatnonzero(np.diff(keys, prepend=-1))
            freqs = np.diff(new, append=len(keys))
            keys = keys[new]
            ends = np.searchsorted(keys, np.arange(1, len(texts) + 1) * width)
            codes = keys % width
            steps = np.diff(codes, prepend=0)
            first = np.concatenate([[0], ends[:-1]])[np.diff(ends, prepend=0) > 0]
            steps[first] = codes[first]
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([base + number], pa.int64()),
                    _one_list(batch.column("doc_id")),
                    _one_list(sizes),
                    _one_list(pa.array(ends, pa.int64())),
                    pa.array([_pack(steps)], pa.binary()),
                    pa.array([_pack(freqs)], pa.binary()),
                    _one_list(dictionary.cast(pa.string())),
                ],
                names=["chunk", "doc_id", "n_bytes", "ends", "codes", "freqs", "units"],
            )
            pa.default_memory_pool().release_unused()

    return wide_input(docs, "doc_id", "text").mapInArrow(run, CHUNKS)


def pieces_of_units(units: DataFrame, tokenizer: str, tasks: int) -> DataFrame:
    """Step 2: (chunk, code, pieces) of (chunk, code, unit), each distinct unit counted in one task."""

    def run(batches):
        encoder = pieces(tokenizer)
        for batch in batches:
            if batch.num_rows:
                coded = pc.dictionary_encode(batch.column("unit"))
                at = encoder._learn(coded.dictionary.to_pylist())
                n = encoder.lengths[at][coded.indices.to_numpy(zero_copy_only=False)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("chunk"), batch.column("code"), pa.array(n.astype(np.int32))],
                    names=["chunk", "code", "pieces"],
                )

    return units.repartition(tasks, "unit").mapInArrow(run, "chunk long, code int, pieces int")


def count_tokens(docs: DataFrame, tokenizer: str, chunk_bytes: int = 16 << 20, task_bytes: int = 32 << 20) -> DataFrame:
    """doc_id, n_bytes, n_tokens for every row of ``docs`` (doc_id, text).  The chunks' pre-tokens are dealt
    to tasks of about ``task_bytes``, however many there are."""
    chunks = staged(chunked_frequencies(docs, tokenizer, chunk_bytes), "frequencies")
    units = chunks.select("chunk", F.posexplode("units").alias("code", "unit"))
    # a pre-token comes with two numbers and the overhead of a row
    size = F.aggregate("units", F.lit(0).cast("long"), lambda a, u: a + F.octet_length(u) + 40)
    total_bytes = chunks.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    tasks = max(chunks.sparkSession.sparkContext.defaultParallelism, -(-total_bytes // task_bytes))
    counted = pieces_of_units(units, tokenizer, tasks)
    per_chunk = counted.groupBy("chunk").agg(F.collect_list("code").alias("code"), F.collect_list("pieces").alias("pieces"))
    # a chunk of empty texts has no units
    both = chunks.drop("units").join(per_chunk, "chunk", "left")

    def total(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                get = lambda c: one.column(c).flatten().to_numpy(zero_copy_only=False)
                ends = get("ends")
                n = np.zeros(len(ends), np.int64)
                if len(ends) and ends[-1]:
                    table = np.zeros(len(get("code")), np.int64)
                    table[get("code")] = get("pieces")
                    steps, freqs = (_unpack(one.column(c)[0].as_py()).astype(np.int64) for c in ("codes", "freqs"))
                    begin = np.concatenate([[0], ends[:-1]])
                    live = ends > begin
                    run = np.cumsum(steps)
                    before = np.where(begin[live] > 0, run[begin[live] - 1], 0)
                    codes = run - np.repeat(before, (ends - begin)[live])
                    n[live] = np.add.reduceat(table[codes] * freqs, begin[live])
                yield pa.RecordBatch.from_arrays(
                    [one.column("doc_id").flatten(), one.column("n_bytes").flatten(), pa.array(n)],
                    names=["doc_id", "n_bytes", "n_tokens"],
                )

    return both.mapInArrow(total, "doc_id long, n_bytes long, n_tokens long")
