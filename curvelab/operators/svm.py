"""M1: linear SVM training (hinge loss, L2, full-batch gradient descent).

Update rule (fixed; it equals the gradient-descent SVM of Spark MLlib with its
defaults): ``ys = 2*label - 1``, ``w0 = 0`` and for ``i = 1..iters``

    active = ys * (w . x) < 1
    g      = -(1/n) * sum_active(ys * x)
    st     = step / sqrt(i)
    w      = w * (1 - st * reg) - st * g

stopping after iteration ``i >= 2`` when
``||w_i - w_{i-1}|| < tol * max(||w_i||, 1)``.  No intercept; a row is
predicted 1 when its margin is ``> 0`` (margin 0 -> class 0).
Defaults: iters 100, step 1.0, reg 0.01, tol 0.001.

Every trainer here fits *many* models at once as a weight matrix
(dims x models); a model is a (task, size) pair whose rows are picked by a
mask, so a whole learning curve shares its passes over the data.

A model whose training rows are none (its size lies below every ordinal of its
classes) is returned too: ``n_train`` 0 and null weights.  Rows without a class
take no part.  Requests (``specs``) are lists of ``ModelSpec`` or a DataFrame with
the columns ``task_type, class_a, class_b, size, iters``, so a request derived from
the data never needs to pass through the driver.

Trainers (same models from each; which one runs changes no row):
  * ``train_grouped``   -- groups of at most about ``MODELS_PER_GROUP`` models of one size
    train in one task each.  The training rows are written once and read by the
    tasks in slices (``shared_rows``), neither copied per group nor shuffled.
    Default for learning curves.
  * ``train_gram``      -- the weights stay combinations of training rows, so one matrix of
    inner products of the rows of the largest size trains the models of all smaller
    sizes as its leading submatrices; the vectors are read once to make it and once to turn
    the combinations into weights, by no iteration.  For vectors that are longer than the
    training rows are many.
  * ``train_iterative`` -- spreads the rows of each model over the cluster: one Spark
    job per iteration for a block of models (``mapInArrow`` partial gradients per
    partition, a JVM vector-sum aggregate); the driver and the broadcast hold one
    block of weights (``BLOCK_BYTES``); input written to the shared folder.
  * ``train_mllib``     -- MLlib ``SVMWithSGD`` on one model, parity checks only.

With ``errors=True`` a trainer adds ``n_wrong`` (A4): the training rows that the final weights predict wrongly,
counted where the rows are at hand (grouped, gram) or in one more pass of the model's slot (iterative), so the
training error needs no scan of its own.  Models without training rows have null there.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvelab.operators.shared_rows import SharedRows, part_files
from curvelab.session import materialize, shared_path

# Fixed defaults of the update rule (see module docstring).
DEFAULT_ITERS = 100
DEFAULT_STEP = 1.0
DEFAULT_REG = 0.01
DEFAULT_TOL = 0.001

TASK_1V1 = "1vs1"
TASK_1VALL = "1vsall"

MODEL_SCHEMA = (
    "task_type string, class_a string, class_b string, size int, iters int, "
    "n_train bigint, iters_run int, weights array<double>, intercept double, threshold double"
)


SPEC_SCHEMA = "task_type string, class_a string, class_b string, size int, iters int"
SPEC_COLUMNS = ["task_type", "class_a", "class_b", "size", "iters"]

# Weights of the models that the iterative trainer advances together.
BLOCK_BYTES = 8 << 20
# Rows multiplied at once: keeps rows x max(dims, models) x 8 bytes near this size
# whatever the vector width.
SLICE_BYTES = 32 << 20


def slice_rows(width: int) -> int:
    """Rows per matrix product for vectors / model sets of ``width``."""
    return max(1, SLICE_BYTES // (8 * max(width, 1)))


def row_slices(n: int, step: int):
    for start in range(0, n, step):
        yield start, min(n, start + step)


@dataclass(frozen=True)
class ModelSpec:
    task_type: str
    class_a: str
    class_b: str | None
    size: int
    iters: int = DEFAULT_ITERS

    def key(self):
        return (self.task_type, self.class_a, self.class_b, self.size, self.iters)


# --------------------------------------------------------------------------
# numpy core


def fit_slices(slices, models: int, iters: int, step=DEFAULT_STEP, reg=DEFAULT_REG, tol=DEFAULT_TOL):
    """Fit one model per column over rows that come in slices.

    ``slices()`` yields (X (n, d) float64, Y (n, T) labels in {0, 1}, M (n, T) bool row
    masks) anew for every pass.  Returns (W (d, T) or None without rows, iters_run (T,),
    n_train (T,))."""
    W, n_t = None, np.zeros(models, np.int64)
    for X, _, M in slices():
        n_t += M.sum(axis=0)
        W = np.zeros((X.shape[1], models)) if W is None else W
    done = n_t == 0
    iters_run = np.zeros(models, dtype=np.int32)
    for i in range(1, iters + 1):
        todo = np.flatnonzero(~done)
        if todo.size == 0:
            break
        Wt = W[:, todo]
        total = np.zeros_like(Wt)
        for X, Y, M in slices():
            St = np.where(M[:, todo], 2.0 * Y[:, todo] - 1.0, 0.0)
            act = (St * (X @ Wt) < 1.0) & M[:, todo]
            total += X.T @ np.where(act, St, 0.0)
        W[:, todo] = step_update(Wt, -total / n_t[todo], i, step, reg)
        iters_run[todo] = i
        if i >= 2:
            done[todo] = converged(Wt, W[:, todo], tol)
    return W, iters_run, n_t


def fit_matrix(X, Y, M, iters, step=DEFAULT_STEP, reg=DEFAULT_REG, tol=DEFAULT_TOL):
    """``fit_slices`` on one slice: X (n, d) float64, Y (n, T), M (n, T)."""
    W, iters_run, n_t = fit_slices(lambda: [(X, Y, M)], Y.shape[1], iters, step, reg, tol)
    return W, iters_run, n_t


def fit_gram(K, Y, M, iters, step=DEFAULT_STEP, reg=DEFAULT_REG, tol=DEFAULT_TOL):
    """Fit one model per column from inner products alone.

    K (n, n) inner products of the rows, Y (n, T) labels, M (n, T) row masks.  Returns (C (n, T),
    iters_run, n_train): the weights of model t are ``X.T @ C[:, t]``.  The margins of all rows are
    ``K @ C``; they serve the next step's test for activity and, with C, the norms of the stop rule."""
    n_t = M.sum(axis=0)
    C, margins = np.zeros(M.shape), np.zeros(M.shape)
    done = n_t == 0
    iters_run = np.zeros(M.shape[1], dtype=np.int32)
    S = np.where(M, 2.0 * Y - 1.0, 0.0)
    for i in range(1, iters + 1):
        todo = np.flatnonzero(~done)
        if todo.size == 0:
            break
        old, reach, St = C[:, todo], margins[:, todo], S[:, todo]
        act = (St * reach < 1.0) & M[:, todo]
        new = step_update(old, -np.where(act, St, 0.0) / n_t[todo], i, step, reg)
        now = K @ new
        C[:, todo], margins[:, todo], iters_run[todo] = new, now, i
        if i >= 2:
            moved = ((new - old) * (now - reach)).sum(axis=0)
            size = (new * now).sum(axis=0)
            done[todo] = np.sqrt(np.maximum(moved, 0)) < tol * np.maximum(np.sqrt(np.maximum(size, 0)), 1.0)
    return C, iters_run, n_t


def wrong_rows(slices, W) -> np.ndarray:
    """Training rows of each model that its weights predict wrongly; ``slices()`` as in ``fit_slices``."""
    wrong = np.zeros(W.shape[1], np.int64)
    for X, Y, M in slices():
        wrong += (((X @ W > 0) != (Y > 0.5)) & M).sum(axis=0)
    return wrong


def step_update(W, G, i, step=DEFAULT_STEP, reg=DEFAULT_REG):
    """Step ``i`` of every column; ``i`` may hold a number for each."""
    st = step / np.sqrt(i)
    return W * (1.0 - st * reg) - st * G


def converged(W_old, W_new, tol=DEFAULT_TOL):
    diff = np.linalg.norm(W_new - W_old, axis=0)
    return diff < tol * np.maximum(np.linalg.norm(W_new, axis=0), 1.0)


# --------------------------------------------------------------------------
# masks shared by trainers and scoring


def class_index(specs) -> dict:
    names = sorted({s.class_a for s in specs} | {s.class_b for s in specs if s.class_b is not None})
    return {c: i for i, c in enumerate(names)}


def spec_arrays(specs, index):
    a = np.array([index[s.class_a] for s in specs], dtype=np.int64)
    b = np.array([index[s.class_b] if s.class_b is not None else -2 for s in specs], dtype=np.int64)
    is_all = np.array([s.task_type == TASK_1VALL for s in specs])
    sizes = np.array([s.size for s in specs], dtype=np.int64)
    return a, b, is_all, sizes


def masks(codes, nums, a, b, is_all, sizes, train: bool):
    """Row x model masks and labels.  codes: class codes (-1 unknown)."""
    in_task = is_all[None, :] | (codes[:, None] == a[None, :]) | (codes[:, None] == b[None, :])
    split = nums[:, None] <= sizes[None, :] if train else nums[:, None] > sizes[None, :]
    M = in_task & split
    Y = (codes[:, None] != a[None, :]).astype(np.float64)
    return M, Y


def arrow_matrix(col: pa.ChunkedArray | pa.Array, dims: int | None = None) -> np.ndarray:
    """list<double> column -> (n, d) float64 matrix (fixed width required)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    if n == 0:
        return np.zeros((0, dims or 0))
    if col.null_count:
        raise ValueError("null feature vector")
    lens = pc.list_value_length(col).to_numpy(zero_copy_only=False)
    d = int(lens[0]) if dims is None else dims
    if (lens != d).any():
        raise ValueError(f"feature vectors must all have {d} dimensions")
    flat = pc.list_flatten(col).to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(n, d)


def arrow_codes(col, index: dict) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    names = pa.array(list(index.keys()), type=pa.string())
    codes = pc.index_in(col.cast(pa.string()), value_set=names)
    return pc.fill_null(codes, -1).to_numpy(zero_copy_only=False).astype(np.int64)


# --------------------------------------------------------------------------
# Spark trainers


def spec_frame(spark: SparkSession, specs) -> DataFrame:
    """A request as a DataFrame without repeats."""
    if isinstance(specs, DataFrame):
        return specs.select(*[F.col(f.split()[0]).cast(f.split()[1]) for f in SPEC_SCHEMA.split(", ")]).distinct()
    return spark.createDataFrame([s.key() for s in dict.fromkeys(specs)], SPEC_SCHEMA)


def _model_rows(specs, W, iters_run, n_t, wrong=None):
    out = []
    for j, s in enumerate(specs):
        weights = [float(v) for v in W[:, j]] if n_t[j] else None
        errors = () if wrong is None else (int(wrong[j]) if n_t[j] else None,)
        out.append((*s.key(), int(n_t[j]), int(iters_run[j]), weights, 0.0, 0.0, *errors))
    return out


def _schema(errors: bool) -> str:
    return f"{MODEL_SCHEMA}, n_wrong bigint" if errors else MODEL_SCHEMA


# Named classes up to this many are a scan filter, more are a join.
FILTER_CLASSES = 1000


@dataclass
class Prepared:
    """A request and its training rows, written once; what a trainer needs to know of both."""

    specs: DataFrame
    models: int
    sizes: int  # distinct sizes
    least: int | None  # smallest and largest size
    most: int | None
    has_all: bool
    named: list[str] | None  # classes that a request given as a list names
    present: list[str] | None = None  # those of them that have training rows
    table: DataFrame | None = None
    files: list[str] | None = None
    n_rows: int = 0
    width: int = 1


def prepared(rows: DataFrame, specs) -> Prepared:
    """Request and training rows (``class_name, num, features``), each evaluated once.  A request that comes
    as a list needs no job of its own."""
    spark = rows.sparkSession
    if isinstance(specs, DataFrame):
        frame = materialize(spec_frame(spark, specs), "request", cluster_by=None)
        models, sizes, least, most, has_all = frame.agg(
            F.count(F.lit(1)), F.count_distinct("size"), F.min("size"), F.max("size"),
            F.max((F.col("task_type") == TASK_1VALL).cast("int")),
        ).first()
        named, names = frame, None
    else:
        distinct = list(dict.fromkeys(specs))
        frame, models = spec_frame(spark, distinct), len(distinct)
        all_sizes = {s.size for s in distinct}
        sizes, least, most = len(all_sizes), min(all_sizes, default=None), max(all_sizes, default=None)
        has_all = any(s.task_type == TASK_1VALL for s in distinct)
        named = {c for s in distinct for c in (s.class_a, s.class_b) if c is not None}
        names = sorted(named) if len(named) <= FILTER_CLASSES else None
    out = Prepared(frame, models, sizes, least, most, bool(has_all), names)
    if models:
        train = training_rows(rows, None if has_all else named, most)
        out.table = materialize(train, "training_rows")
        out.files = part_files(out.table)
        known = F.collect_set(F.when(F.col("class_name").isin(names or []), F.col("class_name")))  # at most the named ones
        n, width, present = out.table.agg(F.count(F.lit(1)), F.max(F.size("features")), known).first()
        out.n_rows, out.width, out.present = n, max(1, width or 1), present
    return out


def training_rows(rows: DataFrame, named, max_size: int) -> DataFrame:
    """Rows any model can train on: ``num <= max(size)``, a class, and, without a 1-vs-all task,
    only the named classes (a set, or a DataFrame of specs).  Projection keeps the three columns the
    trainers read."""
    train = rows.filter((F.col("num") <= F.lit(max_size)) & F.col("class_name").isNotNull()).select("class_name", "num", "features")
    if isinstance(named, set) and len(named) > FILTER_CLASSES:
        named = rows.sparkSession.createDataFrame([(c, None) for c in sorted(named)], "class_a string, class_b string")
    if isinstance(named, set):
        train = train.filter(F.col("class_name").isin(sorted(named)))
    elif named is not None:
        names = named.select(F.explode(F.array("class_a", "class_b")).alias("class_name")).distinct()
        train = train.join(names, "class_name", "left_semi")
    return train


def grouped_memory_bytes(class_count: int, size: int, dims: int) -> int:
    """Bytes of the training rows of the largest size, if every class has that many."""
    return size * class_count * dims * 8


# Models trained together in one grouped task; a size with more models is split
# into several groups that train in parallel.
MODELS_PER_GROUP = 64


# Training rows up to which a task holds their inner products (128 MB), and the shortest vectors for which
# ``auto`` takes them.
GRAM_ROWS, GRAM_DIMS = 4096, 512


def _groups(request: Prepared, buckets: int, *keys: str) -> DataFrame:
    """Specs dealt to buckets, one list for each bucket (and key)."""
    bucket = F.pmod(F.xxhash64("class_a", "class_b", "task_type", "iters"), F.lit(buckets))
    lists = request.specs.withColumn("bucket", bucket).groupBy(*keys, "bucket")
    return lists.agg(F.sort_array(F.collect_list(F.struct(*SPEC_COLUMNS))).alias("specs")).select("specs")


def _model_batch(rows) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), [*_MODEL_TYPES, pa.int64()])]
    return pa.RecordBatch.from_arrays(columns, names=[*_MODEL_NAMES, "n_wrong"][: len(columns)])


def inner_products(slices: SharedRows, n: int) -> tuple[np.ndarray, np.ndarray, list]:
    """(inner products of all rows, their nums, their class names), in the order of the slices, two
    slices in memory at a time."""
    K, nums, names = np.empty((n, n)), [], []
    low = 0
    for part in slices:
        X = arrow_matrix(part.column("features"))
        nums.append(part.column("num").to_numpy(zero_copy_only=False).astype(np.int64))
        names += part.column("class_name").to_pylist()
        high, start = low + len(X), 0
        for other in slices:
            if start <= low:
                Z = X if start == low else arrow_matrix(other.column("features"))
                K[low:high, start : start + len(Z)] = X @ Z.T
                K[start : start + len(Z), low:high] = K[low:high, start : start + len(Z)].T
            start += other.num_rows
        low = high
    return K, np.concatenate(nums) if nums else np.empty(0, np.int64), names


def train_gram(rows: DataFrame, specs, step=DEFAULT_STEP, reg=DEFAULT_REG, tol=DEFAULT_TOL,
               models_per_group: int = MODELS_PER_GROUP, slice_bytes: int = SLICE_BYTES, request: Prepared | None = None,
               errors: bool = False) -> DataFrame:
    """One task per group of classes with all their sizes.  Rows in order of ``num``: those of a size are the
    first ones, its inner products a leading submatrix.  At most ``GRAM_ROWS`` training rows."""
    spark = rows.sparkSession
    request = request or prepared(rows, specs)
    if not request.models:
        return spark.createDataFrame([], _schema(errors))
    if request.n_rows > GRAM_ROWS:
        raise ValueError(f"{request.n_rows} training rows; inner products are held for at most {GRAM_ROWS}")
    files, n, width = request.files, request.n_rows, request.width
    per_slice = max(1, slice_bytes // (8 * width))
    buckets = max(1, math.ceil(request.models / max(1, request.sizes) / models_per_group))

    def fit_groups(batches):
        made = None
        for batch in batches:
            for group in batch.column("specs").to_pylist():
                if made is None:
                    shared = SharedRows(files, ["class_name", "num", "features"], per_slice)
                    K, nums, names = inner_products(shared, n)
                    order = np.argsort(nums, kind="stable")
                    made = shared, K[np.ix_(order, order)], nums[order], [names[k] for k in order]
                    del K
                shared, K, nums, names = made
                group_specs = [ModelSpec(**g) for g in group]
                index = class_index(group_specs)
                codes = np.array([index.get(c, -1) for c in names], np.int64)
                mine, fitted, coefficients = [], [], []
                for size, iters in sorted({(s.size, s.iters) for s in group_specs}):
                    some = [s for s in group_specs if (s.size, s.iters) == (size, iters)]
                    first = int(np.searchsorted(nums, size, side="right"))
                    a, b, is_all, sizes = spec_arrays(some, index)
                    M, Y = masks(codes[:first], nums[:first], a, b, is_all, sizes, train=True)
                    C, run, n_t = fit_gram(K[:first, :first], Y, M, iters, step, reg, tol)
                    mine += some
                    fitted.append((run, n_t))
                    whole = np.zeros((n, len(some)))
                    whole[order[:first]] = C
                    coefficients.append(whole)
                C = np.concatenate(coefficients, axis=1)
                W, low = np.zeros((width, C.shape[1])), 0
                for part in shared:
                    W += arrow_matrix(part.column("features")).T @ C[low : low + part.num_rows]
                    low += part.num_rows
                run, n_t = (np.concatenate(v) for v in zip(*fitted))
                wrong = None
                if errors:
                    wrong = wrong_rows(lambda: masked_slices(shared, mine, index), W)
                yield _model_batch(_model_rows(mine, W, run, n_t, wrong))

    return _groups(request, buckets).repartition(buckets).mapInArrow(fit_groups, _schema(errors))


def masked_slices(shared, specs, index):
    """Vectors, labels and masks of the written training rows, slice by slice, for models of a request."""
    a, b, is_all, sizes = spec_arrays(specs, index)
    for part in shared:
        X = arrow_matrix(part.column("features"))
        nums = part.column("num").to_numpy(zero_copy_only=False).astype(np.int64)
        M, Y = masks(arrow_codes(part.column("class_name"), index), nums, a, b, is_all, sizes, train=True)
        yield X, Y, M


def train_grouped(rows: DataFrame, specs, step=DEFAULT_STEP, reg=DEFAULT_REG, tol=DEFAULT_TOL,
                  models_per_group: int = MODELS_PER_GROUP, slice_bytes: int = SLICE_BYTES, request: Prepared | None = None,
                  errors: bool = False) -> DataFrame:
    """One task per group of models of a size; each reads the written training rows with
    ``num <= size`` slice by slice, once per iteration (from memory where they fit)."""
    spark = rows.sparkSession
    request = request or prepared(rows, specs)
    if not request.models:
        return spark.createDataFrame([], _schema(errors))
    models, sizes, files = request.models, request.sizes, request.files
    per_slice = max(1, slice_bytes // (8 * max(request.width, models_per_group)))
    buckets = max(1, math.ceil(models / max(1, sizes) / models_per_group))
    groups = _groups(request, buckets, "size")

    def fit_groups(batches):
        shared, shared_size = None, None
        for batch in batches:
            for group in batch.column("specs").to_pylist():
                group_specs = [ModelSpec(**g) for g in group]
                size = group_specs[0].size
                if shared_size != size:
                    shared_size = size
                    shared = SharedRows(files, ["class_name", "num", "features"], per_slice,
                                        filters=lambda b, size=size: pc.less_equal(b.column("num"), size))
                index = class_index(group_specs)
                out = []
                for iters in sorted({s.iters for s in group_specs}):
                    mine = [s for s in group_specs if s.iters == iters]

                    def slices(shared=shared, mine=mine, index=index):
                        return masked_slices(shared, mine, index)

                    W, run, n_t = fit_slices(slices, len(mine), iters, step, reg, tol)
                    wrong = None
                    if errors:
                        wrong = wrong_rows(slices, W) if W is not None else n_t
                    out += _model_rows(mine, W, run, n_t, wrong)
                yield _model_batch(out)

    return groups.repartition(sizes * buckets).mapInArrow(fit_groups, _schema(errors))


_MODEL_NAMES = [f.split()[0] for f in MODEL_SCHEMA.split(", ")]
_MODEL_TYPES = [
    {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "array<double>": pa.list_(pa.float64())}[f.split()[1]]
    for f in MODEL_SCHEMA.split(", ")
]


def _waiting(specs: DataFrame):
    """The request as a queue, models with the most iterations first; the driver fetches it as it goes."""
    for r in specs.orderBy(F.desc("iters"), *SPEC_COLUMNS).toLocalIterator():
        yield ModelSpec(r["task_type"], r["class_a"], r["class_b"], r["size"], r["iters"])


def train_iterative(rows: DataFrame, specs, step=DEFAULT_STEP, reg=DEFAULT_REG, tol=DEFAULT_TOL,
                    partition_bytes: int = 64 << 20, block_bytes: int = BLOCK_BYTES, request: Prepared | None = None,
                    errors: bool = False) -> DataFrame:
    """Distributed passes over the training rows, each one iteration of every model that holds a slot.

    There are as many slots as weights fit ``block_bytes``.  A model that has converged or reached its
    iterations leaves its slot to the next one of the queue, so no pass waits for the stragglers of a block.
    The driver holds the slots' weights and receives their summed gradients; finished models are written
    as a table, a block at a time.  With ``errors`` a finished model keeps its slot for one more pass, whose
    margins are those of its final weights."""
    spark = rows.sparkSession
    request = request or prepared(rows, specs)
    if not request.models:
        return spark.createDataFrame([], _schema(errors))
    dims = request.width
    # read from the shared folder (a lost executor reads it again instead of computing the plan again);
    # every pass launches one task a partition, so the rows are packed into partitions of about
    # ``partition_bytes`` (a no-op where there are no more partitions than that)
    train = request.table.coalesce(max(1, math.ceil(request.n_rows * (8 * dims + 64) / partition_bytes)))
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    path = shared_path(spark, "trained")

    def write(models):
        spark.createDataFrame(models, _schema(errors)).write.mode("append").parquet(path)

    slots = max(1, block_bytes // (8 * dims))
    waiting, finished = _waiting(request.specs), []
    live, W, at, closing = [], np.zeros((dims, 0)), np.zeros(0, np.int64), np.zeros(0, bool)
    while True:
        joining = list(itertools.islice(waiting, slots - len(live)))
        live += joining
        W = np.concatenate([W, np.zeros((dims, len(joining)))], axis=1)
        at = np.concatenate([at, np.zeros(len(joining), np.int64)])
        closing = np.concatenate([closing, np.zeros(len(joining), bool)])
        if not live:
            break
        G, n_t, wrong = _gradient_pass(train, live, W)
        wanted = np.array([s.iters for s in live])
        steps = (n_t > 0) & (wanted > 0) & ~closing
        now = W.copy()
        at[steps] += 1
        now[:, steps] = step_update(W[:, steps], -G[:, steps] / n_t[steps], at[steps], step, reg)
        done = ~steps | (at >= wanted) | ((at >= 2) & converged(W, now, tol))
        W = now
        leaves = ~steps if errors else done
        left = np.flatnonzero(leaves)
        finished += _model_rows([live[j] for j in left], W[:, left], at[left], n_t[left], wrong[left] if errors else None)
        if len(finished) >= slots:
            write(finished)
            finished = []
        live, W, at, closing = [s for s, out in zip(live, leaves) if not out], W[:, ~leaves], at[~leaves], done[~leaves]
    if finished:
        write(finished)
    train.unpersist()
    return spark.read.schema(_schema(errors)).parquet(path)


def _gradient_pass(train: DataFrame, specs: list[ModelSpec], W) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One pass over the training rows: (sums of the active rows' signed vectors (d, T), training rows (T,), those
    that the weights predict wrongly (T,))."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    index = class_index(specs)
    bc = train.sparkSession.sparkContext.broadcast((W, *spec_arrays(specs, index), index))

    def partial_gradients(batches, bc=bc):
        Wt, ta, tb, tall, tsz, idx = bc.value
        g, cnt, wrong = np.zeros_like(Wt), np.zeros(len(ta), np.int64), np.zeros(len(ta), np.int64)
        for batch in batches:
            feats = batch.column("features")
            codes = arrow_codes(batch.column("class_name"), idx)
            nums = batch.column("num").to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi in row_slices(batch.num_rows, slice_rows(len(ta))):
                X = arrow_matrix(feats.slice(lo, hi - lo))
                M, Y = masks(codes[lo:hi], nums[lo:hi], ta, tb, tall, tsz, train=True)
                S = np.where(M, 2.0 * Y - 1.0, 0.0)
                margins = X @ Wt
                act = (S * margins < 1.0) & M
                g += X.T @ np.where(act, S, 0.0)
                cnt += M.sum(axis=0)
                wrong += (((margins > 0) != (Y > 0.5)) & M).sum(axis=0)
        if not cnt.any():
            return
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, g.size + 1, len(g), dtype=np.int32)), pa.array(g.T.ravel()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(g.shape[1], dtype=np.int32)), pa.array(cnt), pa.array(wrong), lists], names=["t", "n", "wrong", "g"]
        )

    # partial sums combined by a JVM vector aggregate; the driver gets one row per model in a slot
    summed = (
        train.mapInArrow(partial_gradients, "t int, n bigint, wrong bigint, g array<double>")
        .groupBy("t")
        .agg(F.sum("n").alias("n"), F.sum("wrong").alias("wrong"), Summarizer.sum(array_to_vector("g")).alias("g"))
        .collect()
    )
    bc.destroy()
    G, n_t, wrong = np.zeros(W.shape), np.zeros(len(specs), np.int64), np.zeros(len(specs), np.int64)
    for r in summed:
        G[:, r["t"]], n_t[r["t"]], wrong[r["t"]] = r["g"].toArray(), r["n"], r["wrong"]
    return G, n_t, wrong


def train_mllib(labeled: DataFrame, iters=DEFAULT_ITERS, step=DEFAULT_STEP, reg=DEFAULT_REG, tol=DEFAULT_TOL):
    """Parity trainer: MLlib SVMWithSGD on ``label double, features array<double>``.
    Returns (weights list, intercept)."""
    from pyspark.mllib.classification import SVMWithSGD
    from pyspark.mllib.regression import LabeledPoint

    rdd = labeled.select("label", "features").rdd.map(lambda r: LabeledPoint(r[0], r[1]))
    model = SVMWithSGD.train(rdd, iterations=iters, step=step, regParam=reg, miniBatchFraction=1.0,
                             convergenceTol=tol)
    return list(model.weights.toArray()), float(model.intercept)


def choose_trainer(class_count: int, size: int, dims: int, limit_bytes: int = 256 << 20) -> str:
    """'grouped' while a task can run through the training rows of the largest size quickly,
    'iterative' where they are worth spreading.  Both give the same models."""
    return "grouped" if grouped_memory_bytes(class_count, size, dims) <= limit_bytes else "iterative"


def train(rows: DataFrame, specs, trainer: str = "auto", request: Prepared | None = None, **kw) -> DataFrame:
    """Models of a request.  ``auto`` chooses by the written training rows: inner products where the vectors
    are long and the rows fewer than their dimensions, groups in tasks while a task can run through the rows
    quickly, else passes over the cluster."""
    request = request or prepared(rows, specs)
    if trainer == "auto":
        n, width = request.n_rows, request.width
        trainer = choose_trainer(1, n, width)
        if trainer == "grouped" and width >= GRAM_DIMS and n <= min(width, GRAM_ROWS):
            trainer = "gram"
    trainers = {"grouped": train_grouped, "gram": train_gram, "iterative": train_iterative}
    if trainer not in trainers:
        raise ValueError(f"unknown trainer {trainer!r}")
    return trainers[trainer](rows, specs, request=request, **kw)
