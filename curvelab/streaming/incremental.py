"""M11 as a stream: featurize only files that were not featurized before.

The file source records every file it has processed in the query's
checkpoint, so re-running the job (``trigger(availableNow=True)``) picks up
exactly the new files, exactly once, and survives lost executors and driver
restarts.  Output is appended to one Parquet feature table (not one object
per image).

Two inputs are supported:
  * ``kind="json"``  -- one JSON float array per file (``<class>_<num>.jpg.json``);
  * ``kind="image"`` -- raw files (any format) read as bytes; ``model_factory``
    turns a batch of byte strings into vectors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from curvelab.functions.names import base_name, class_and_num
from curvelab.operators import models as model_table
from curvelab.operators import score as scoring
from curvelab.operators.featurize import featurize
from curvelab.operators.svm import TASK_1VALL
from curvelab.session import materialize
from curvelab.sources.readers import parse_feature_json
from curvelab.sources.optional import read_if_there


def _json_stream(spark: SparkSession, input_dir: str, glob: str, max_files: int | None):
    r = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    raw = r.load(input_dir).select("value", F.col("_metadata.file_name").alias("file_name"))
    return parse_feature_json(raw).select("file_name", "class_name", "num", "features")


def _image_stream(spark: SparkSession, input_dir: str, glob: str, max_files: int | None,
                  model_factory: Callable, dims: int | None):
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    r = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    files = r.load(input_dir)
    cn = class_and_num(base_name("path"))
    named = files.select(
        base_name("path").alias("file_name"),
        cn.getField("class_name").alias("class_name"),
        cn.getField("num").alias("num"),
        "content",
    )
    return featurize(named, model_factory, "content", "features", dims).drop("content")


def featurize_new_files(spark: SparkSession, input_dir: str, output_dir: str, checkpoint_dir: str,
                        kind: str = "json", glob: str | None = None, model_factory: Callable | None = None,
                        dims: int | None = None, max_files_per_trigger: int | None = None) -> int:
    """Process every file not seen by earlier runs, append features, return the
    number of rows written by this run (counted in the output's own file log)."""
    if kind == "json":
        stream = _json_stream(spark, input_dir, glob or "*.json", max_files_per_trigger)
    elif kind == "image":
        if model_factory is None:
            raise ValueError("image featurization needs a model_factory")
        stream = _image_stream(spark, input_dir, glob or "*.jpg", max_files_per_trigger, model_factory, dims)
    else:
        raise ValueError(f"unknown kind {kind!r}")
    return _run(stream, output_dir, checkpoint_dir)


def classify_new_files(spark: SparkSession, input_dir: str, model_path: str, output_dir: str, checkpoint_dir: str,
                       size: int | None = None, iters: int | None = None, glob: str = "*.json",
                       max_files_per_trigger: int | None = None) -> int:
    """M9 as a stream: class names for JSON feature files that arrived since the
    last run, from the saved one-vs-all models (one per class; lowest margin
    wins), appended to ``output_dir``.  Returns the rows written by this run."""
    saved = model_table.load_models(spark, model_path).filter(F.col("task_type") == TASK_1VALL)
    if size is not None:
        saved = saved.filter(F.col("size") == F.lit(size))
    if iters is not None:
        saved = saved.filter(F.col("iters") == F.lit(iters))
    models = materialize(saved, "stream_models", cluster_by=None)
    n, classes = models.agg(F.count(F.lit(1)), F.count_distinct("class_a")).first()
    if not n or n != classes:
        raise ValueError("need exactly one saved one-vs-all model per class")
    records = _json_stream(spark, input_dir, glob, max_files_per_trigger)
    predicted = scoring.classify_records(records, models, keep=["file_name"])
    return _run(predicted, output_dir, checkpoint_dir)


def _run(stream, output_dir: str, checkpoint_dir: str) -> int:
    """Runs the stream until its input is used up; returns the rows it wrote, counted in the files
    that the sink committed meanwhile."""
    spark = stream.sparkSession
    before = materialize(_committed_files(spark, output_dir), "files_before", cluster_by=None)
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(output_dir)
    )
    query.awaitTermination()
    new = _committed_files(spark, output_dir).join(before, "name", "left_anti")
    written = read_if_there(lambda: spark.read.parquet(output_dir))
    if written is None:  # nothing was ever written
        return 0
    return written.select(F.col("_metadata.file_name").alias("name")).join(new, "name", "left_semi").count()


def _committed_files(spark: SparkSession, output_dir: str):
    """Names of the sink's committed files; a listing, bodies are not read."""
    files = read_if_there(lambda: spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(output_dir))
    if files is None:
        return spark.createDataFrame([], "name string")
    return files.select(base_name("path").alias("name")).distinct()
