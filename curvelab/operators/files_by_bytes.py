"""M10 over files: listed files dealt to tasks by their bytes, opened and featurized there in groups of bounded bytes.

A task's work is the bytes it reads, not the number of its files.  Prefix sums over the listed lengths give
each file the position where it begins in the whole; the task is that position divided by the bytes of a
task.  So a task holds less than ``task_bytes`` and one file more, whether the files are one huge one or
ten thousand small ones.  Bodies stay in the Python worker: a group is read, featurized and let go.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curvelab.operators.shared_rows import open_uri
from curvelab.session import materialize

# Bytes of files a task begins with, bytes of bodies held at once (a larger file is a group of its own), and
# what opening a file costs, in bytes.
TASK_BYTES = 128 << 20
GROUP_BYTES = 32 << 20
OPEN_BYTES = 64 << 10


def dealt_by_bytes(files: DataFrame, task_bytes: int = TASK_BYTES, open_bytes: int = OPEN_BYTES) -> DataFrame:
    """``files`` (with ``length``) in partitions whose files begin within ``task_bytes`` of each other, fewer
    where there would be idle cores.  A null length counts as nothing."""
    spark = files.sparkSession
    weight = F.coalesce(F.col("length"), F.lit(0)) + F.lit(open_bytes)
    listed = materialize(
        files.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at"), weight.alias("_weight")),
        "files",
        cluster_by=None,
    )
    # one row for each partition of the listing
    parts = listed.groupBy("_part").agg(F.sum("_weight").alias("_bytes"))
    total = parts.agg(F.sum("_bytes")).first()[0]
    if not total:
        return listed.drop("_part", "_at", "_weight")
    each = max(1, min(task_bytes, math.ceil(total / spark.sparkContext.defaultParallelism)))
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = parts.select("_part", F.coalesce(F.sum("_bytes").over(upto), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum("_weight").over(inside), F.lit(0)) + F.col("_shift")
    placed = listed.join(shift, "_part").withColumn("_task", F.floor(begin / each).cast("int"))
    return placed.repartitionById(math.ceil(total / each), "_task").drop("_part", "_at", "_weight", "_shift", "_task")


def groups_by_bytes(lengths, group_bytes: int = GROUP_BYTES):
    """(first, last + 1) of runs of files that hold at most ``group_bytes``, or one file."""
    first, held = 0, 0
    for i, n in enumerate(lengths):
        if i > first and held + (n or 0) > group_bytes:
            yield first, i
            first, held = i, 0
        held += n or 0
    if first < len(lengths):
        yield first, len(lengths)


def _body(uri: str) -> bytes:
    store, path = open_uri(uri)
    with store.open_input_stream(path) as f:
        return f.read()


def featurize_files(files: DataFrame, model_factory: Callable[[], Callable], out_col: str = "features", dims: int | None = None,
                    task_bytes: int = TASK_BYTES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """The listed ``files`` (``path``, ``length``, any other columns) with the vectors of their bodies.

    ``model_factory()`` is called once a task; its model gets the bodies of one group at a time."""
    dealt = dealt_by_bytes(files, task_bytes)
    names = dealt.columns

    def run(batches):
        model = None
        for batch in batches:
            model = model or model_factory()
            table = pa.Table.from_batches([batch])
            for first, end in groups_by_bytes(batch.column("length").to_pylist(), group_bytes):
                part = table.slice(first, end - first).combine_chunks()
                bodies = pd.Series([_body(uri) for uri in part.column("path").to_pylist()], dtype=object)
                found = np.asarray(model(bodies), dtype=np.float64)
                if dims is not None and found.shape[1] != dims:
                    raise ValueError(f"model returned {found.shape[1]} dims, expected {dims}")
                yield from part.append_column(out_col, pa.array(list(found), pa.list_(pa.float64()))).to_batches()

    fields = ", ".join([f"`{n}` {dealt.schema[n].dataType.simpleString()}" for n in names] + [f"`{out_col}` array<double>"])
    return dealt.mapInArrow(run, fields)
