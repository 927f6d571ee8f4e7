"""Rows of a written table, read inside tasks in bounded batches.

Some tables must meet every row of another one (models and the rows they score, training
rows and the models they train) without being broadcast whole.  They are written to the
shared folder, and each task reads their Parquet files batch by batch through
``pyarrow.fs``, as often as it needs; what fits a byte budget is kept in the task's memory
in between.  The folder must be one whose URI ``pyarrow.fs`` opens.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame

# What a task may keep of a shared table between two passes over it.
KEEP_BYTES = 64 << 20


def part_files(table: DataFrame) -> list[str]:
    """URIs of the files behind a table that was just written and read again."""
    return sorted(table.inputFiles())


def open_uri(uri: str):
    """(file system, path) of a file or folder named by a URI or a plain path."""
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.FileSystem.from_uri("file://" + uri.removeprefix("file:"))


class SharedRows:
    """The batches of a written table, or what ``make`` makes of each; iterating again reads again, or
    takes what was kept.  ``reads`` counts the passes over the files."""

    def __init__(self, files: list[str], columns: list[str], batch_rows: int, filters=None, keep_bytes: int = KEEP_BYTES, make=None):
        self.files, self.columns, self.batch_rows = files, columns, max(1, batch_rows)
        self.filters, self.keep_bytes, self.make = filters, keep_bytes, make
        self.kept: list | None = None
        self.reads = 0

    def _read(self) -> Iterator[pa.RecordBatch]:
        for uri in self.files:
            store, path = open_uri(uri)
            with store.open_input_file(path) as f:
                for batch in pq.ParquetFile(f).iter_batches(batch_size=self.batch_rows, columns=self.columns):
                    if self.filters is not None:
                        batch = batch.filter(self.filters(batch))
                    if batch.num_rows:
                        yield batch

    def __iter__(self) -> Iterator:
        if self.kept is not None:
            yield from self.kept
            return
        self.reads += 1
        kept, size = [], 0
        for batch in self._read():
            made = batch if self.make is None else self.make(batch)
            if kept is not None:
                size += batch.nbytes
                if size <= self.keep_bytes:
                    kept.append(made)
                else:
                    kept = None
            yield made
        self.kept = kept


def gathered(batches: Iterable[pa.RecordBatch], budget: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches together, of about ``budget`` bytes, so that what must meet every row is read once for
    so many of them; empty batches are left out."""
    some: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            some.append(batch)
            size += batch.nbytes
        if size >= budget:
            yield some
            some, size = [], 0
    if some:
        yield some
