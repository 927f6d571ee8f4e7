"""K1-K5.  All writers replace their target (``mode('overwrite')``) unless told
otherwise, which is what the reference does by deleting files first."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelab.functions.vectors import encode_feature_json, encode_feature_line, encode_labeled_line


def write_labeled_features(df: DataFrame, path: str, fmt: str = "text", mode: str = "overwrite") -> None:
    """K1: rows with ``label, features, split`` -> ``split=train`` / ``split=test`` folders.

    ``fmt='text'`` writes ``label,f1,f2,...`` lines, ``'parquet'`` typed columns."""
    w = df.write.mode(mode).partitionBy("split")
    if fmt == "text":
        df.select(encode_labeled_line("label", "features").alias("value"), "split").write.mode(mode).partitionBy(
            "split"
        ).text(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def write_label_map(label_map: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K2: ``label_idx, class_name`` rows -> one JSON object ``{"0": "class", ...}``.
    The map has one entry per class (small); it is built by one global aggregate."""
    obj = label_map.agg(
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(
            F.struct(F.col("label_idx").cast("string"), F.col("class_name"))
        )))).alias("value")
    )
    obj.coalesce(1).write.mode(mode).text(path)


def write_features(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                   partition_by: str | None = None, cluster_by: str | None = "num") -> None:
    """K3: one dataset (not one object per image): Parquet, ``class,num,f1, f2`` text,
    or JSON-array text.

    Parquet files are sorted by ``cluster_by`` inside each task (no shuffle), so
    row-group statistics let a training scan (``num <= max(size)``) skip most of
    the table."""
    if fmt == "parquet":
        if cluster_by and cluster_by in df.columns:
            df = df.sortWithinPartitions(cluster_by)
        w = df.write.mode(mode)
        if partition_by:
            w = w.partitionBy(partition_by)
        w.parquet(path)
    elif fmt == "lines":
        df.select(encode_feature_line("class_name", "num", "features").alias("value")).write.mode(mode).text(path)
    elif fmt == "json":
        df.select(encode_feature_json("features").alias("value")).write.mode(mode).text(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def save_mllib_model(model: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4 in MLlib's folder layout (readable by ``SVMModel.load``): one model row
    with ``weights array<double>, intercept, threshold``.  The layout is one JSON
    metadata line plus a one-row Parquet file holding the old-style vector."""
    from pyspark.mllib.linalg import Vectors as MVectors
    from pyspark.mllib.linalg import VectorUDT
    from pyspark.sql.types import DoubleType, StructField, StructType

    spark = model.sparkSession
    rows = model.select("weights", "intercept", "threshold").limit(2).collect()  # one model
    if len(rows) != 1:
        raise ValueError("save_mllib_model writes exactly one model")
    r = rows[0]
    meta = json.dumps({
        "class": "org.apache.spark.mllib.classification.SVMModel",
        "version": "1.0",
        "numFeatures": len(r["weights"]),
        "numClasses": 2,
    })
    spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode(mode).text(f"{path}/metadata")
    schema = StructType([
        StructField("weights", VectorUDT(), False),
        StructField("intercept", DoubleType(), False),
        StructField("threshold", DoubleType(), True),
    ])
    data = [(MVectors.dense(r["weights"]), float(r["intercept"]), r["threshold"])]
    spark.createDataFrame(data, schema).coalesce(1).write.mode(mode).parquet(f"{path}/data")


def write_results(curve: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K5: ``size,success`` CSV with a header, one folder ``task_type=.../target=...`` per curve
    (target: the class, or the pair as ``a_vs_b``), ordered by size inside its file."""
    target = F.concat_ws("_vs_", "class_a", "class_b")
    rows = curve.select("size", F.col("success_pct").alias("success"), "task_type", target.alias("target"))
    # the rows of one curve meet in one task: as many as it has sizes
    rows.repartition("task_type", "target").sortWithinPartitions("task_type", "target", "size").write.mode(mode).option(
        "header", True
    ).partitionBy("task_type", "target").csv(path)


def read_results(spark, path: str) -> DataFrame:
    """The written curves: task_type, target, size, success."""
    return spark.read.option("header", True).schema("size int, success double, task_type string, target string").csv(path).select(
        "task_type", "target", "size", "success"
    )
