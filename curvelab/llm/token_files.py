"""Token ids as flat binary files (operator 10).

Format, per partition of the ascending doc_id order, three raw little-endian files:

* ``<name>.ids``      all ids, unsigned 16 bit where the vocabulary fits, else 32 bit;
* ``<name>.offsets``  int64, one more than documents: where each document starts, in ids;
* ``<name>.docs``     int64 doc_ids (0 for null; null doc_ids come first).

A manifest table lists the files with their counts; the prefix sums of these counts are
the partitions' bases in the whole sequence.  A task writes under a name of its own and
only the manifest's files count, so a repeated or lost task leaves no double.  Files are
read back memory-mapped (in stores without a file path, by plain reads).

The folder must be one that all executors reach; paths go through ``pyarrow.fs``.

Defined results: null text is an empty text, which still has its end id; ties in doc_id
are ordered by a hash of the text; null doc_ids come first; an empty table gives no
files and an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curvelab.llm.common import staged, wide_input
from curvelab.llm.pieces import pieces, small_batches
from curvelab.session import shared_path

MANIFEST = "part int, name string, n_docs long, n_null long, n_ids long, width int"


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as a path or a URI."""
    return fs.FileSystem.from_uri(folder) if "://" in folder else fs.FileSystem.from_uri(f"file://{folder.removeprefix('file:')}")


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Writes the files of all rows of ``docs`` (doc_id, text) in ascending doc_id order and
    returns the manifest with ``base``, the ids before each file."""
    tie = F.xxhash64("text")
    ordered = wide_input(docs, "doc_id", "text").repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", "text")

    def run(batches):
        encoder = pieces(tokenizer)
        kind = np.dtype("<u2") if encoder.vocabulary_size <= 1 << 16 else np.dtype("<u4")
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        store, path = _store(folder)
        store.create_dir(path)
        n_docs = n_null = n_ids = 0
        out = None
        for batch in small_batches(batches, "text", 4 << 20):
            if out is None:
                out = {x: store.open_output_stream(f"{path}/{name}.{x}") for x in ("ids", "offsets", "docs")}
                out["offsets"].write(np.zeros(1, "<i8").tobytes())
            ids, offsets = encoder.encode(batch.column("text"), end_id)
            out["ids"].write(ids.astype(kind).tobytes())
            out["offsets"].write((offsets[1:] + n_ids).astype("<i8").tobytes())
            keys = batch.column("doc_id")
            out["docs"].write(keys.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            n_docs, n_null, n_ids = n_docs + len(keys), n_null + keys.null_count, n_ids + len(ids)
        if out is not None:
            for f in out.values():
                f.close()
            values = [part, name, n_docs, n_null, n_ids, kind.itemsize]
            yield pa.RecordBatch.from_pylist([dict(zip(("part", "name", "n_docs", "n_null", "n_ids", "width"), values))], schema=_MANIFEST)

    manifest = staged(ordered.mapInArrow(run, MANIFEST), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


_MANIFEST = pa.schema(
    [("part", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_null", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32())]
)


def _flat(store: fs.FileSystem, path: str, kind: str) -> np.ndarray:
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype=kind, mode="r")
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), dtype=kind)


def read_token_files(manifest: DataFrame, folder: str, with_ids: bool = True, rows: int = 512) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 of the ids as unsigned
    32-bit integers, and ``ids`` (array<int>, if ``with_ids``) of every document, from the files."""

    def run(batches):
        for batch in batches:
            for one in batch.to_pylist():
                store, path = _store(folder)
                stem = f"{path}/{one['name']}"
                ids = _flat(store, f"{stem}.ids", f"<u{one['width']}")
                offsets, docs = _flat(store, f"{stem}.offsets", "<i8"), _flat(store, f"{stem}.docs", "<i8")
                for at in range(0, one["n_docs"], rows):
                    to = min(at + rows, one["n_docs"])
                    ends = np.asarray(offsets[at : to + 1])
                    block = np.asarray(ids[ends[0] : ends[-1]]).astype("<u4")
                    cuts = ends - ends[0]
                    crc = [zlib.crc32(block[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
                    columns = [
                        pa.array(np.asarray(docs[at:to]), mask=np.arange(at, to) < one["n_null"]),
                        pa.array(ends[:-1] + one["base"]),
                        pa.array(np.diff(ends)),
                        pa.array(crc, pa.int64()),
                    ]
                    if with_ids:
                        columns.append(pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(block.astype(np.int32))))
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    files = manifest.count()
    return manifest.repartition(max(1, files)).mapInArrow(run, schema)


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None) -> tuple[DataFrame, str]:
    """Writes ``docs`` into a new folder (by default under the shared one): manifest and folder."""
    folder = folder or shared_path(docs.sparkSession, "token_files")
    return write_token_files(docs, folder, tokenizer, end_id), folder
