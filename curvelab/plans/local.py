"""M7 / M8: the folder-based train and test commands.

``train_local``: quota split -> labels -> write labelled features and label
map -> train -> training error -> save models (replacing earlier ones).
``test_saved``: read test features, label map and models back and report the
test error.  With more than two classes the reference would feed labels
0..k-1 to a binary SVM; here every class gets a one-vs-all model and the
lowest margin names the class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvelab.functions import class_and_num, class_from_first_digit, label_1v1
from curvelab.operators import labels as lab
from curvelab.operators import metrics, splits, svm
from curvelab.operators import models as model_table
from curvelab.operators import score as scoring
from curvelab.operators.svm import DEFAULT_ITERS, TASK_1V1, TASK_1VALL, ModelSpec
from curvelab.plans.curves import all_targets
from curvelab.plans.requests import RequestError, check_classes, parse_pair
from curvelab.session import materialize
from curvelab.sinks.writers import write_label_map, write_labeled_features
from curvelab.sources.readers import read_label_map, read_labeled_lines


def _paths(out_dir: str) -> dict:
    base = out_dir.rstrip("/")
    return {"features": f"{base}/features", "labels": f"{base}/labels", "models": f"{base}/models"}


def train_local(features: DataFrame, n_train: int, out_dir: str, classes=None, iters: int = DEFAULT_ITERS,
                trainer: str = "auto") -> DataFrame:
    """M7.  ``features``: ``file_name string, features array<double>``.

    Returns the training error per saved model.
    """
    if int(n_train) <= 0:
        raise RequestError(f"training size ({n_train}) must be greater than zero")
    spark = features.sparkSession
    stem = F.regexp_replace("file_name", r"[.]json$", "")
    rows = features.select(
        "file_name",
        class_from_first_digit("file_name").alias("class_name"),
        class_and_num(stem).getField("num").alias("file_num"),
        "features",
    ).where(F.col("class_name").isNotNull())
    if classes is not None:
        a, b = parse_pair(classes)
        rows = splits.filter_two_classes(rows, a, b)
        mapping = spark.createDataFrame([(0, a), (1, b)], "label_idx int, class_name string")
    else:
        # computed once: written, and read by the labels, the map file and the trainer
        mapping = materialize(lab.label_map(rows), "label_map", cluster_by=None)
    split = splits.split_quota(rows, n_train, order_cols=("file_num", "file_name"))
    labelled = (
        split.withColumn("label", label_1v1("class_name", a)) if classes is not None
        else lab.label_index(split, mapping=mapping)
    )
    p = _paths(out_dir)
    write_labeled_features(labelled.select("label", "features", "split"), p["features"])
    write_label_map(mapping, p["labels"])

    # trainers select rows by ``num <= size``: train rows get 1, test rows size + 1
    n = int(n_train)
    staged = spark.read.text(p["features"]).select("value", "split")
    from curvelab.sources.readers import parse_labeled_lines

    # one row per class; AQE broadcasts it from its measured size
    parsed = parse_labeled_lines(staged).join(mapping, F.col("label").cast("int") == F.col("label_idx"))
    train_rows = parsed.select(
        "class_name", "features",
        F.when(F.col("split") == "train", F.lit(1)).otherwise(F.lit(n + 1)).alias("num"),
    )
    if classes is not None:
        specs = svm.spec_frame(spark, [ModelSpec(TASK_1V1, a, b, n, iters)])
    else:
        specs = all_targets(mapping, [n], iters)
    # the trainer counts the wrong rows of its final weights: no second scan of the training rows
    trained = materialize(svm.train(train_rows, specs, trainer=trainer, errors=True), "trained", cluster_by=None)
    model_table.save_models(model_table.with_version(trained, "local"), p["models"], mode="overwrite")
    return trained.select(
        "task_type", "class_a", "class_b", "size", "iters", "n_train", "n_wrong",
        metrics.error_rate("n_train", "n_wrong").alias("error_rate"),
    )


def test_saved(spark: SparkSession, out_dir: str, classes=None) -> DataFrame:
    """M8: test error of the saved models on the saved test features."""
    p = _paths(out_dir)
    mapping = read_label_map(spark, p["labels"])
    test = read_labeled_lines(spark, f"{p['features']}/split=test")
    saved = model_table.load_models(spark, p["models"])
    if classes is not None:
        a, b = parse_pair(classes)
        check_classes(mapping, [a, b])
        m = saved.filter((F.col("task_type") == TASK_1V1) & (F.col("class_a") == a) & (F.col("class_b") == b)).limit(1).collect()
        if not m:
            raise RequestError(f"no saved model for {a} vs {b}")
        pred = scoring.svm_predict(test, m[0]["weights"], m[0]["intercept"], m[0]["threshold"])
        return metrics.error_counts(pred)
    models = saved.filter(F.col("task_type") == TASK_1VALL)
    if models.isEmpty():
        raise RequestError("no saved one-vs-all models")
    pred = scoring.classify_records(test, models, keep=["label"])
    decoded = pred.join(mapping.select(F.col("label_idx").cast("double").alias("prediction"),
                                       F.col("class_name").alias("predicted_class")),
                        "predicted_class", "left")
    return metrics.error_counts(decoded)
