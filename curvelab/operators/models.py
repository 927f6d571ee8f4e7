"""The model table.

Models are rows, keyed by ``(task_type, class_a, class_b, size, iters,
data_version)`` -- exact keys, unlike a path-prefix test, and 1-vs-1 and
1-vs-all models can never collide.  The table is Parquet partitioned by
``task_type``; new models are appended, so concurrent curves never rewrite
each other's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvelab.operators.svm import spec_frame
from curvelab.session import materialize
from curvelab.sources.optional import read_if_there

KEY_COLS = ["task_type", "class_a", "class_b", "size", "iters", "data_version"]
TABLE_SCHEMA = (
    "task_type string, class_a string, class_b string, size int, iters int, data_version string, "
    "n_train bigint, iters_run int, weights array<double>, intercept double, threshold double"
)
KEY_SCHEMA = "task_type string, class_a string, class_b string, size int, iters int, data_version string"


def keys_frame(spark: SparkSession, specs, data_version: str) -> DataFrame:
    """The keys of a request (a list of ``ModelSpec`` or a DataFrame) under one data version."""
    return spec_frame(spark, specs).withColumn("data_version", F.lit(data_version))


def key_match(left: DataFrame, right: DataFrame, cols=KEY_COLS):
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(right[c])
        cond = e if cond is None else cond & e
    return cond


def load_models(spark: SparkSession, path: str) -> DataFrame:
    """The model table, or an empty frame when none was written yet."""
    stored = read_if_there(lambda: spark.read.schema(TABLE_SCHEMA).parquet(path))
    if stored is None:
        return spark.createDataFrame([], TABLE_SCHEMA)
    return stored.select(*[f.split()[0] for f in TABLE_SCHEMA.split(", ")])


def missing_models(requested: DataFrame, models: DataFrame) -> DataFrame:
    """Requested keys with no model yet (null-safe exact key anti join)."""
    m = models.select(*KEY_COLS)
    return requested.join(m, key_match(requested, m), "left_anti")


def existing_models(requested: DataFrame, models: DataFrame) -> DataFrame:
    """Models whose key was requested (left semi join, its form left to the planner).
    One row per key even if two runs appended the same model."""
    req = requested.select(*KEY_COLS)
    return models.join(req, key_match(models, req), "left_semi").dropDuplicates(KEY_COLS)


def save_models(models: DataFrame, path: str, mode: str = "append") -> None:
    """K4: append new model rows (or replace the whole table with mode='overwrite')."""
    models.select(*[f.split()[0] for f in TABLE_SCHEMA.split(", ")]).write.mode(mode).partitionBy(
        "task_type"
    ).parquet(path)


def with_version(models: DataFrame, data_version: str) -> DataFrame:
    return models.withColumn("data_version", F.lit(data_version))


def get_or_train(rows: DataFrame, specs, path: str, data_version: str, train_fn) -> DataFrame:
    """M6: reuse stored models, train only the missing keys, append them, return all requested.

    ``train_fn(rows, specs) -> DataFrame`` of trained models (svm.MODEL_SCHEMA); it gets the
    missing keys as a DataFrame.  A key that has no training rows is not stored, so it is
    tried again when rows have arrived; it is returned without weights."""
    spark = rows.sparkSession
    requested = keys_frame(spark, specs, data_version)
    stored = load_models(spark, path)
    todo = materialize(missing_models(requested, stored), "missing_models", cluster_by=None)
    if todo.isEmpty():
        return existing_models(requested, stored)
    new = materialize(with_version(train_fn(rows, todo.drop("data_version")), data_version), "new_models", cluster_by=None)
    save_models(new.where(F.col("n_train") > 0), path)
    columns = [f.split()[0] for f in TABLE_SCHEMA.split(", ")]
    empty = new.where(F.col("n_train") == 0).select(*columns)
    return existing_models(requested, load_models(spark, path)).select(*columns).unionByName(empty)
