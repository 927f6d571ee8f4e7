"""The reference's programs as single calls.

* ``extract_features`` -- raw images -> one feature table, featurizing only
  images that are not in the table yet (M10 + M11).
* ``curve_job``        -- feature table -> learning curve with model reuse and a
  ``size,success`` result file (M5 + M6 + K5 + M12): the cluster command
  ``--1vs1 A,B | --1vsAll A --size 3,5,.. [--iter n]``.
* ``classify_files``   -- JSON feature files -> class names with saved
  one-vs-all models (M9): the ``--check`` command, for any number of files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvelab.functions.names import base_name, class_and_num
from curvelab.operators import models as model_table
from curvelab.operators import score as scoring
from curvelab.operators.featurize import skip_if_featurized
from curvelab.operators.files_by_bytes import featurize_files
from curvelab.operators.svm import DEFAULT_ITERS, TASK_1V1, TASK_1VALL
from curvelab.plans import curves
from curvelab.plans.requests import RequestError, validate_request
from curvelab.session import materialize
from curvelab.sinks.writers import write_results
from curvelab.sources.optional import read_if_there
from curvelab.sources.readers import list_inputs, read_feature_json

FEATURE_COLUMNS = ["path", "file_name", "class_name", "num", "features"]


def extract_features(spark: SparkSession, image_dir: str, table_path: str, model_factory: Callable,
                     dims: int | None = None, glob: str = "*.jpg") -> int:
    """Featurize the images under ``image_dir`` that ``table_path`` does not hold yet
    and append them; returns the number of new rows.

    The folder is listed without bodies, paths that have features are taken out (anti
    join on paths; equal names in different folders are different images), and only the
    remaining files are opened, inside the tasks that featurize them.  A table without a
    ``path`` column is matched by ``file_name``, and rows without a path are appended to it."""
    new = materialize(new_image_features(spark, image_dir, table_path, model_factory, dims, glob), "new_features", cluster_by=None)
    there = read_if_there(lambda: spark.read.parquet(table_path))
    columns = new.columns if there is None or "path" in there.columns else new.columns[1:]
    new.select(*columns).write.mode("append").parquet(table_path)
    return new.count()


def new_image_features(spark: SparkSession, image_dir: str, table_path: str, model_factory: Callable,
                       dims: int | None = None, glob: str = "*.jpg") -> DataFrame:
    """Features of the images that ``table_path`` does not hold; files are dealt to tasks by their bytes."""
    named = class_and_num(base_name("path"))
    todo = list_inputs(spark, image_dir, glob=glob).select(
        "path", "length", "file_name", named.getField("class_name").alias("class_name"), named.getField("num").alias("num")
    )
    there = read_if_there(lambda: spark.read.parquet(table_path))
    if there is not None:
        todo = skip_if_featurized(todo, there, key="path" if "path" in there.columns else "file_name")
    return featurize_files(todo, model_factory, "features", dims).select(*FEATURE_COLUMNS)


def curve_job(spark: SparkSession, features: str | DataFrame, one_vs_one=None, one_vs_all=None,
              sizes="3,5,7,10,13,16,20,25,30,40,50,60,70,80,90,100", iters: int = DEFAULT_ITERS,
              model_path: str | None = None, data_version: str = "v1", results_path: str | None = None,
              trainer: str = "auto") -> DataFrame:
    """Learning curve of one 1-vs-1 pair or of 1-vs-all target(s) over a feature table."""
    task = validate_request(one_vs_one=one_vs_one, one_vs_all=one_vs_all)
    rows = spark.read.parquet(features) if isinstance(features, str) else features
    rows = rows.select("class_name", "num", "features")
    classes = one_vs_one if task == TASK_1V1 else one_vs_all
    curve = curves.learning_curve(rows, task, classes, sizes, iters, trainer=trainer, model_path=model_path,
                                  data_version=data_version)
    if results_path is not None:
        curve = materialize(curve, "curve", cluster_by=None)  # read by the writer and the caller
        write_results(curve, results_path)
    return curve.orderBy("task_type", "class_a", "class_b", "size")


def classify_files(spark: SparkSession, json_dir: str, model_path: str, size: int | None = None,
                   iters: int | None = None, data_version: str | None = None, glob: str = "*.json") -> DataFrame:
    """Class name for every JSON feature file, from the saved one-vs-all models
    (one per class; the lowest margin wins)."""
    saved = model_table.load_models(spark, model_path).filter(F.col("task_type") == TASK_1VALL)
    for col, val in (("size", size), ("iters", iters), ("data_version", data_version)):
        if val is not None:
            saved = saved.filter(F.col(col) == F.lit(val))
    one_model_per_class(saved)
    records = read_feature_json(spark, json_dir, glob=glob)
    return scoring.classify_records(records, saved, keep=["file_name"])


def one_model_per_class(models: DataFrame) -> None:
    """Raises unless there is at least one model and no class has two."""
    n, classes = models.agg(F.count(F.lit(1)), F.count_distinct("class_a")).first()
    if not n:
        raise RequestError("no saved one-vs-all models match")
    if n != classes:
        raise RequestError("several saved models per class; pick size / iters / data_version")
