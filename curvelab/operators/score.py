"""M2 / M9: scoring.

* ``svm_predict``   -- one model, per-row prediction as a JVM expression
  (``margin > threshold`` -> 1.0; no prediction for a bad vector).
* ``score_models``  -- any number of models over the whole table in one scan, blocked on
  two levels: a task gathers rows up to ``ROW_BYTES``, then runs them through the models
  block by block (``BLOCK_BYTES`` of weights, ``shared_rows``), so models that do not fit
  its memory are read once for that many rows and not for every Arrow batch.  It emits
  only per-model counts (map-side combine) before a ``groupBy``.  Rows are never joined with
  models, and no model passes through the driver.
* ``classify_records`` -- one-vs-all models of any number of classes, the class whose
  model gives the **lowest** margin wins (the target class is label 0).  Each record
  keeps its lowest margin while the blocks of models pass, so it stays one row and
  needs no key; the same code runs on streams.  With ``search="tree"`` a block is a ball tree
  (``ball_tree``): only models whose ball can hold a lower margin are multiplied with a record.
  Class and margin are the same; the product is the default because it was faster on every layout measured.

Block and slice sizes bound the memory of a task; they change no result.
"""

from __future__ import annotations

import json
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelab.functions.vectors import dot
from curvelab.operators.ball_tree import LEAF_MODELS, BallTree
from curvelab.operators.shared_rows import SharedRows, gathered, part_files
from curvelab.operators.svm import (
    FILTER_CLASSES,
    TASK_1VALL,
    Prepared,
    arrow_codes,
    arrow_matrix,
    masks,
    row_slices,
    slice_rows,
)
from curvelab.session import materialize

# Weights held at once by a task: one block of models.
BLOCK_BYTES = 16 << 20
# Rows that a task gathers for one pass over the models.
ROW_BYTES = 64 << 20
MODEL_COLUMNS = ["task_type", "class_a", "class_b", "size", "iters", "weights", "intercept", "threshold"]


def svm_predict(df: DataFrame, weights, intercept: float = 0.0, threshold: float = 0.0,
                features: str = "features", out: str = "prediction") -> DataFrame:
    """M2: ``1.0`` when ``w . x + intercept > threshold`` else ``0.0``; null when the vector is null, of
    another length than the model, or holds nulls."""
    w = F.from_json(F.lit(json.dumps([float(v) for v in weights])), "array<double>")  # one literal
    x = F.col(features)
    margin = dot(x, w) + F.lit(float(intercept or 0.0))
    good = F.coalesce((F.size(x) == len(weights)) & ~F.exists(x, lambda v: v.isNull()), F.lit(False))
    predicted = F.when(margin > F.lit(float(threshold or 0.0)), F.lit(1.0)).otherwise(F.lit(0.0))
    return df.withColumn(out, F.when(good, predicted))


def as_models(spark, models) -> DataFrame:
    """Model rows as a DataFrame; takes a DataFrame or a list of rows."""
    if isinstance(models, DataFrame):
        return models
    from curvelab.operators.svm import MODEL_SCHEMA

    names = [f.split()[0] for f in MODEL_SCHEMA.split(", ")]
    rows = [tuple((r if isinstance(r, dict) else r.asDict()).get(c) for c in names) for r in models]
    return spark.createDataFrame(rows, MODEL_SCHEMA)


class ModelBlock:
    """One block of models as arrays; models without weights have a zero column and ``trained`` false."""

    def __init__(self, batch: pa.RecordBatch):
        self.class_a = batch.column("class_a").to_pylist()
        self.class_b = batch.column("class_b").to_pylist()
        self.sizes = batch.column("size").to_numpy(zero_copy_only=False).astype(np.int64)
        self.is_all = np.array([t == TASK_1VALL for t in batch.column("task_type").to_pylist()])
        self.intercept = batch.column("intercept").fill_null(0.0).to_numpy(zero_copy_only=False)
        self.threshold = batch.column("threshold").fill_null(0.0).to_numpy(zero_copy_only=False)
        weights = batch.column("weights")
        lists = weights.to_numpy(zero_copy_only=False)
        dims = {len(w) for w in lists if w is not None and len(w)}
        if len(dims) > 1:
            raise ValueError("models have different dimensions")
        self.dims = dims.pop() if dims else None
        self.trained = np.array([w is not None and len(w) > 0 for w in lists], dtype=bool)
        self.W = np.zeros((self.dims or 0, len(lists)))
        for j in np.flatnonzero(self.trained):
            self.W[:, j] = lists[j]
        names = sorted({*self.class_a, *(b for b in self.class_b if b is not None)})
        self.index = {c: i for i, c in enumerate(names)}
        self.a = np.array([self.index[c] for c in self.class_a], np.int64)
        self.b = np.array([self.index[c] if c is not None else -2 for c in self.class_b], np.int64)
        self.ids = batch.column("m").to_numpy(zero_copy_only=False) if "m" in batch.schema.names else None
        self.by_name = np.array(sorted(range(len(lists)), key=self.class_a.__getitem__), np.int64)
        self.names = np.array(self.class_a, dtype=object)[self.by_name]

    @cached_property
    def tree(self) -> BallTree:
        """The models as a ball tree, in the order of ``names``."""
        return BallTree(self.W.T[self.by_name], self.intercept[self.by_name])

    def margins(self, X: np.ndarray) -> np.ndarray:
        if self.dims is None:
            return np.zeros((len(X), len(self.class_a)))
        return X @ self.W + self.intercept[None, :]


def _blocks(files: list[str], columns: list[str], block_models: int) -> SharedRows:
    return SharedRows(files, columns, block_models, make=ModelBlock)


def _block_models(dims: int | None, block_models: int | None) -> int:
    return int(block_models) if block_models else max(1, BLOCK_BYTES // (8 * max(1, dims or 1)))


def count_rows(batches, blocks, train: bool, row_bytes: int):
    """(model ids, rows, wrong rows, rows of label 1) of every block of models, over all batches."""
    counts: dict[int, list] = {}
    for some in gathered(batches, row_bytes):
        for at, blk in enumerate(blocks):
            n, wrong, pos = np.zeros((3, len(blk.a)), np.int64)
            step = slice_rows(max(len(blk.a), blk.dims or 1))
            for batch in some:
                feats = batch.column("features")
                codes = arrow_codes(batch.column("class_name"), blk.index)
                nums = batch.column("num").to_numpy(zero_copy_only=False).astype(np.int64)
                for lo, hi in row_slices(batch.num_rows, step):
                    X = arrow_matrix(feats.slice(lo, hi - lo), blk.dims)
                    M, Y = masks(codes[lo:hi], nums[lo:hi], blk.a, blk.b, blk.is_all, blk.sizes, train=train)
                    positive = Y > 0.5
                    n += M.sum(0)
                    pos += (positive & M).sum(0)
                    wrong += (((blk.margins(X) > blk.threshold[None, :]) != positive) & M).sum(0)
            if at in counts:
                for total, part in zip(counts[at][1:], (n, wrong, pos)):
                    total += part
            else:
                counts[at] = [blk.ids, n, wrong, pos]
    return counts.values()


def lowest_by_product(blk: ModelBlock, X: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``blk.names``, margin) of the lowest margin of every row, every margin computed.  A margin that is
    no number never wins; a row without another one has no number."""
    margins = blk.margins(X)[:, blk.by_name]
    k = np.argmin(margins, axis=1)
    value = margins[np.arange(len(X)), k]
    some = np.flatnonzero(np.isnan(value))
    some = some[~np.isnan(margins[some]).all(axis=1)]
    if some.size:
        k[some] = np.nanargmin(margins[some], axis=1)
        value[some] = margins[some, k[some]]
    return k, value


def lowest_margins(batches, blocks, features: str, row_bytes: int, search: str = "product"):
    """(batch, name of the model with the lowest margin, that margin) of every batch."""
    for some in gathered(batches, row_bytes):
        best = [np.full(b.num_rows, None, dtype=object) for b in some]
        low = [np.full(b.num_rows, np.inf) for b in some]
        for blk in blocks:
            for batch, names, margin in zip(some, best, low):
                feats = batch.column(features)
                at_once = 2 * LEAF_MODELS if search == "tree" else len(blk.names)
                for lo, hi in row_slices(batch.num_rows, slice_rows(max(at_once, blk.dims))):
                    X = arrow_matrix(feats.slice(lo, hi - lo), blk.dims)
                    k, value = blk.tree.lowest(X, margin[lo:hi]) if search == "tree" else lowest_by_product(blk, X)
                    name = blk.names[k]
                    tie = (k >= 0) & (value == margin[lo:hi])
                    tie[tie] = [old is None or new < old for new, old in zip(name[tie], names[lo:hi][tie])]
                    better = (value < margin[lo:hi]) | tie
                    names[lo:hi][better], margin[lo:hi][better] = name[better], value[better]
        yield from zip(some, best, low)


def score_models(
    rows: DataFrame, models, split: str = "test", block_models: int | None = None, row_bytes: int = ROW_BYTES,
    request: Prepared | None = None,
) -> DataFrame:
    """Every model's row (keys, ``n_train``) with ``n_rows, n_wrong, n_pos`` on the test
    (``num > size``) or train split.

    ``models``: model rows (``svm.MODEL_SCHEMA``) as a DataFrame or a list.  Rows without a
    class take no part.  A model without weights has ``n_wrong`` null.  ``request``: what these models were
    trained from, if at hand; its sizes, width and classes are then not asked of the models again."""
    spark = rows.sparkSession
    models = as_models(spark, models)
    carried = [c for c in ("n_train", "data_version") if c in models.columns]
    table = materialize(
        models.select(*MODEL_COLUMNS, *carried, F.monotonically_increasing_id().alias("m")), "models", cluster_by=None
    )
    if request is None:
        lo, hi, has_all, dims = table.agg(
            F.min("size"), F.max("size"), F.max((F.col("task_type") == TASK_1VALL).cast("int")), F.max(F.size("weights"))
        ).first()
    else:
        lo, hi, has_all, dims = request.least, request.most, request.has_all, request.width
    keys = ["task_type", "class_a", "class_b", "size", "iters"]
    out = [*keys, *carried, "n_rows", "n_wrong", "n_pos"]
    if lo is None:
        empty = table.select(*keys, *carried)
        return empty.selectExpr("*", "0L AS n_rows", "0L AS n_wrong", "0L AS n_pos").select(*out)
    files, per_block = part_files(table), _block_models(dims, block_models)
    train = split == "train"
    columns = [*MODEL_COLUMNS, "m"]

    def count_batches(batches):
        blocks = _blocks(files, columns, per_block)
        for ids, n, wrong, pos in count_rows(batches, blocks, train, row_bytes):
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (ids, n, wrong, pos)], names=["m", "n_rows", "n_wrong", "n_pos"])

    cond = (F.col("num") <= hi) if train else (F.col("num") > lo)
    cond = cond & F.col("class_name").isNotNull()
    if not has_all:
        some = request.named if request else None
        if some is None:
            named = table.select(F.explode(F.array("class_a", "class_b")).alias("c")).where("c is not null").distinct()
            some = [r["c"] for r in named.limit(FILTER_CLASSES + 1).collect()]
        if len(some) <= FILTER_CLASSES:
            cond = cond & F.col("class_name").isin(sorted(some))
    parts = rows.filter(cond).select("class_name", "num", "features").mapInArrow(
        count_batches, "m bigint, n_rows bigint, n_wrong bigint, n_pos bigint"
    )
    summed = parts.groupBy("m").agg(*[F.sum(c).alias(c) for c in ("n_rows", "n_wrong", "n_pos")])
    info = table.select(*keys, *carried, "m", (F.coalesce(F.size("weights"), F.lit(-1)) > 0).alias("trained"))
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    return (
        info.join(summed, "m", "left")
        .withColumn("n_wrong", F.when(F.col("trained"), count("n_wrong")))
        .withColumn("n_rows", count("n_rows"))
        .withColumn("n_pos", count("n_pos"))
        .select(*out)
    )


def classify_records(
    records: DataFrame, models, keep, features: str = "features", block_models: int | None = None, row_bytes: int = ROW_BYTES,
    search: str = "product",
) -> DataFrame:
    """M9: ``keep`` columns, predicted class name and margin of every record from one-vs-all models
    (lowest margin wins; ties go to the alphabetically first class).

    ``models``: model rows as a DataFrame or a list; those without weights take no part.
    ``keep`` needs not identify records.  A margin that is no number never wins; a record with no other
    one has no class.  ``search``: ``product`` computes every margin, ``tree`` those that a ball tree cannot
    rule out."""
    if search not in ("product", "tree"):
        raise ValueError(f"unknown search {search!r}")
    spark = records.sparkSession
    keep = [keep] if isinstance(keep, str) else list(keep)
    models = as_models(spark, models).where(F.size("weights") > 0)
    table = materialize(models.select(*MODEL_COLUMNS), "models", cluster_by=None)
    dims = None if block_models else table.agg(F.max(F.size("weights"))).first()[0]
    files, per_block = part_files(table), _block_models(dims, block_models)
    kept = "".join(f"`{c}` {records.schema[c].dataType.simpleString()}, " for c in keep)

    def predict_batches(batches):
        blocks = _blocks(files, MODEL_COLUMNS, per_block)
        for batch, best, low in lowest_margins(batches, blocks, features, row_bytes, search):
            cols = {c: batch.column(c) for c in keep}
            cols["predicted_class"] = pa.array(best, type=pa.string())
            cols["margin"] = pa.array(low)
            yield pa.RecordBatch.from_pydict(cols)

    return records.select(*keep, features).mapInArrow(
        predict_batches, f"{kept}predicted_class string, margin double"
    )
