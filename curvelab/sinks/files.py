"""One file per row, for consumers that want objects instead of a table.

Tasks write the files themselves through ``pyarrow.fs``, each under a temporary name that is
moved to the final one, so a repeated task leaves no half file and no double.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelab.operators.shared_rows import open_uri
from curvelab.session import materialize


def write_files(df: DataFrame, folder: str, name_col: str, body_col: str) -> DataFrame:
    """Writes ``body_col`` (string or binary) of every row to ``folder/name_col``; returns the
    written (file_name, length).  Names must be unique and without ``/``; rows without
    a name or body are not written."""
    rows = df.where(F.col(name_col).isNotNull() & F.col(body_col).isNotNull()).select(
        F.col(name_col).alias("file_name"), F.col(body_col).cast("binary").alias("body")
    )

    def write(batches):
        store, path = open_uri(folder)
        store.create_dir(path)
        for batch in batches:
            sizes = []
            for name, body in zip(batch.column("file_name").to_pylist(), batch.column("body").to_pylist()):
                draft = f"{path}/.{uuid.uuid4().hex}"
                with store.open_output_stream(draft) as f:
                    f.write(body)
                store.move(draft, f"{path}/{name}")
                sizes.append(len(body))
            yield pa.RecordBatch.from_arrays([batch.column("file_name"), pa.array(sizes, pa.int64())], names=["file_name", "length"])

    return materialize(rows.mapInArrow(write, "file_name string, length bigint"), "written_files", cluster_by=None)
