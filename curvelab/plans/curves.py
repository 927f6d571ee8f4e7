"""M3-M5: one-vs-one / one-vs-all evaluation and learning curves.

Plan for a whole curve (all sizes, all targets):
  1. the request as a table of model keys (with target ``all``: the distinct classes
     times the sizes, never a list on the driver);
  2. training: rows with ``num <= max(size)`` only, groups of models in parallel
     (grouped; gram for long vectors) or a block of models per distributed pass (iterative);
  3. the models as a written table; scoring: one scan of the rows, each task runs
     through the models in blocks, per-partition partial counts, final aggregate.
A size below every ordinal of its classes has no training rows: its row has
``n_train`` 0 and null rates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelab.operators import metrics, models as model_table
from curvelab.operators import score as scoring
from curvelab.operators import svm
from curvelab.operators.svm import DEFAULT_ITERS, TASK_1V1, TASK_1VALL, ModelSpec
from curvelab.plans.requests import RequestError, check_classes, known_classes, parse_pair, parse_sizes

CURVE_COLUMNS = [
    "task_type", "class_a", "class_b", "size", "iters", "n_train", "n_test", "n_wrong",
    "error_rate", "success_pct", "majority_pct",
]


def model_specs(rows: DataFrame, task_type: str, classes, sizes, iters: int) -> DataFrame | list[ModelSpec]:
    """The model keys of a curve request: a list for named classes, else a DataFrame."""
    sizes = parse_sizes(sizes)
    if task_type == TASK_1V1:
        a, b = parse_pair(classes)
        return [ModelSpec(TASK_1V1, a, b, s, iters) for s in sizes]
    if task_type == TASK_1VALL:
        if classes is None or classes == "all":
            return all_targets(rows, sizes, iters)
        targets = [classes] if isinstance(classes, str) else list(classes)
        return [ModelSpec(TASK_1VALL, t, None, s, iters) for t in targets for s in sizes]
    raise RequestError(f"unknown task type {task_type!r}")


def all_targets(rows: DataFrame, sizes, iters: int) -> DataFrame:
    """One-vs-all keys of every class of ``rows`` at every size."""
    return known_classes(rows).select(
        F.lit(TASK_1VALL).alias("task_type"),
        F.col("class_name").alias("class_a"),
        F.lit(None).cast("string").alias("class_b"),
        F.explode(F.array(*[F.lit(int(s)) for s in dict.fromkeys(sizes)])).alias("size"),
        F.lit(int(iters)).alias("iters"),
    )


def fit_models(rows: DataFrame, specs: DataFrame | list[ModelSpec], trainer: str = "auto",
               model_path: str | None = None, data_version: str = "v1", **kw) -> DataFrame:
    """Train (or load) the models of ``specs``."""

    def train_fn(r, sp):
        return svm.train(r, sp, trainer=trainer, **kw)

    if model_path is not None:
        return model_table.get_or_train(rows, specs, model_path, data_version, train_fn)
    return train_fn(rows, specs)


def learning_curve(rows: DataFrame, task_type: str, classes, sizes, iters: int = DEFAULT_ITERS,
                   trainer: str = "auto", model_path: str | None = None, data_version: str = "v1",
                   **kw) -> DataFrame:
    """M5: ``(size, success)`` per requested size (and per target for 1-vs-all).

    ``rows``: ``class_name string, num bigint, features array<double>``.
    """
    specs = model_specs(rows, task_type, classes, sizes, iters)
    if model_path is not None:
        if isinstance(specs, list):
            check_classes(rows, named_classes(specs))
        return curve_from_models(rows, fit_models(rows, specs, trainer, model_path, data_version, **kw))
    request = svm.prepared(rows, specs)
    if isinstance(specs, list):
        # a class with training rows exists; only for others need the whole table be asked
        unseen = sorted(set(named_classes(specs)) - set(request.present or []))
        if unseen:
            check_classes(rows, unseen)
    return curve_from_models(rows, svm.train(rows, specs, trainer=trainer, request=request, **kw), request)


def named_classes(specs: list[ModelSpec]) -> list[str]:
    return sorted({c for s in specs for c in (s.class_a, s.class_b) if c is not None})


def curve_from_models(rows: DataFrame, trained, request: svm.Prepared | None = None) -> DataFrame:
    """The curve of trained models (a DataFrame or a list of model rows; ``request`` is what they were
    trained from, if at hand)."""
    return scoring.score_models(rows, trained, split="test", request=request).select(
        "task_type", "class_a", "class_b", "size", "iters", "n_train",
        F.col("n_rows").alias("n_test"),
        "n_wrong",
        metrics.error_rate("n_rows", "n_wrong").alias("error_rate"),
        metrics.success_pct("n_rows", "n_wrong").alias("success_pct"),
        metrics.majority_pct("n_rows", "n_pos").alias("majority_pct"),
    )


def eval_1v1(rows: DataFrame, class_a: str, class_b: str, size: int, iters: int = DEFAULT_ITERS, **kw) -> DataFrame:
    """M3: one size, class_a (label 0) against class_b (label 1)."""
    return learning_curve(rows, TASK_1V1, (class_a, class_b), [size], iters, **kw)


def eval_1vall(rows: DataFrame, target: str, size: int, iters: int = DEFAULT_ITERS, **kw) -> DataFrame:
    """M4: one size, target (label 0) against every other class (label 1)."""
    return learning_curve(rows, TASK_1VALL, target, [size], iters, **kw)
