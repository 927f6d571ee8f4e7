"""The one-call programs: feature extraction, curve job, classify files."""

import json
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from curvelab.plans.jobs import classify_files, curve_job, extract_features, new_image_features
from curvelab.plans.requests import RequestError
from curvelab.operators.files_by_bytes import dealt_by_bytes, featurize_files, groups_by_bytes
from curvelab.session import materialize
from curvelab.sources.readers import list_inputs


def byte_model():
    def model(batch):
        return np.array([[len(b), b[-1], 1.0] for b in batch], dtype=float)

    return model


def test_extract_features_incremental(spark, shared):
    src = shared("img").replace("file:", "")
    table = shared("features")
    os.makedirs(src, exist_ok=True)
    for name in ("pug_1.jpg", "pug_2.jpg", "beagle_1.jpg"):
        with open(f"{src}/{name}", "wb") as f:
            f.write(b"\xff\xd8" + name.encode())
    assert extract_features(spark, src, table, byte_model, dims=3) == 3
    with open(f"{src}/beagle_2.jpg", "wb") as f:
        f.write(b"\xff\xd8zz")
    assert extract_features(spark, src, table, byte_model, dims=3) == 1
    got = sorted((r["class_name"], r["num"]) for r in spark.read.parquet(table).collect())
    assert got == [("beagle", 1), ("beagle", 2), ("pug", 1), ("pug", 2)]
    # names are listed and compared without bodies
    plan = list_inputs(spark, src, glob="*.jpg").select("path", "length")._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"binaryFile \[([^\]]*)\]", plan)
    assert scans and not any("content" in s for s in scans)
    assert new_image_features(spark, src, table, byte_model, dims=3).count() == 0


def test_equal_names_in_different_folders(spark, shared):
    src, table = shared("img").replace("file:", ""), shared("features")

    def put(name):
        os.makedirs(os.path.dirname(f"{src}/{name}"), exist_ok=True)
        with open(f"{src}/{name}", "wb") as f:
            f.write(b"\xff\xd8" + name.encode())

    put("a/cat_1.jpg")
    assert extract_features(spark, src, table, byte_model, dims=3) == 1
    put("b/cat_1.jpg")
    assert extract_features(spark, src, table, byte_model, dims=3) == 1
    assert extract_features(spark, src, table, byte_model, dims=3) == 0
    got = spark.read.parquet(table).collect()
    assert [r["file_name"] for r in got] == ["cat_1.jpg"] * 2 and len({r["path"] for r in got}) == 2


def test_a_table_of_another_kind_is_an_error(spark, shared):
    """Only a missing table counts as none; one without the key column is not taken for absent."""
    from pyspark.errors import AnalysisException

    src, table = shared("img").replace("file:", ""), shared("features")
    os.makedirs(src)
    with open(f"{src}/cat_1.jpg", "wb") as f:
        f.write(b"x")
    spark.range(3).write.parquet(table)
    with pytest.raises(AnalysisException):
        extract_features(spark, src, table, byte_model, dims=3)
    assert spark.read.parquet(table).columns == ["id"]


def test_tables_of_names_only_still_work(spark, shared):
    src, table = shared("img").replace("file:", ""), shared("features")
    os.makedirs(src)
    for name in ("cat_1.jpg", "cat_2.jpg"):
        with open(f"{src}/{name}", "wb") as f:
            f.write(b"xy")
    spark.createDataFrame([("cat_1.jpg", "cat", 1, [1.0])], "file_name string, class_name string, num long, features array<double>").write.parquet(table)
    assert extract_features(spark, src, table, byte_model, dims=3) == 1
    assert sorted(r["file_name"] for r in spark.read.parquet(table).collect()) == ["cat_1.jpg", "cat_2.jpg"]


def test_curve_job_and_classify(spark, rows, shared):
    table = materialize(rows.select(
        F.concat("class_name", F.lit("_"), F.col("num").cast("string"), F.lit(".jpg")).alias("file_name"),
        "class_name", "num", "features"), "features")
    models, res = shared("models"), shared("res")
    curve = curve_job(spark, table, one_vs_all=["breed_a", "breed_b", "breed_c"], sizes="3,5", iters=5,
                      model_path=models, results_path=res)
    assert curve.count() == 6
    assert spark.read.option("header", True).csv(res).count() == 6
    with pytest.raises(RequestError):
        curve_job(spark, table, one_vs_one="breed_a,breed_b", one_vs_all="breed_c")

    src = shared("json").replace("file:", "")
    os.makedirs(src, exist_ok=True)
    for r in rows.filter("num = 40").collect():
        with open(f"{src}/{r['class_name']}_{r['num']}.jpg.json", "w") as f:
            json.dump(list(r["features"]), f)
    with pytest.raises(RequestError):  # two sizes saved per class: ambiguous
        classify_files(spark, src, models)
    got = classify_files(spark, src, models, size=5).collect()
    assert len(got) == 10 and {g["predicted_class"] for g in got} <= {"breed_a", "breed_b", "breed_c"}


def test_files_are_dealt_by_bytes(spark):
    """One huge file and 10,000 small ones: no task holds more than its bytes and one file."""
    huge, each, opened = 5 << 30, 64 << 20, 64 << 10
    files = spark.range(10_001, numPartitions=3).select(
        F.concat(F.lit("p"), "id").alias("path"),
        F.when(F.col("id") == 4000, huge).when(F.col("id") % 1000 != 7, 1000 + F.col("id") % 50_000).alias("length"))
    dealt = dealt_by_bytes(files, each, opened).withColumn("task", F.spark_partition_id())
    tasks = dealt.groupBy("task").agg(F.sum(F.coalesce("length", F.lit(0)) + opened).alias("bytes"), F.max("length").alias("top")).collect()
    assert dealt.count() == 10_001 and dealt.select("path").distinct().count() == 10_001
    assert max(t["bytes"] - ((t["top"] or 0) + opened) for t in tasks) < each  # the one file more is opened too
    assert sum((t["top"] or 0) == huge for t in tasks) == 1 and len(tasks) > 8
    assert dealt_by_bytes(files.where("id < 0")).count() == 0
    assert list(groups_by_bytes([5, 5, 5, 90, None, 3, 3], 10)) == [(0, 2), (2, 3), (3, 4), (4, 7)]
    assert list(groups_by_bytes([], 10)) == []


def test_bodies_are_read_in_groups_of_bounded_bytes(spark, shared):
    src = shared("img").replace("file:", "")
    os.makedirs(src)
    sizes = {f"cat_{i}.jpg": 20_000 if i == 5 else 100 + i for i in range(40)} | {"cat_99.jpg": 0}
    for name, n in sizes.items():
        with open(f"{src}/{name}", "wb") as f:
            f.write(b"x" * n)

    def group_size():
        return lambda bodies: np.array([[len(b), sum(map(len, bodies)), len(bodies)] for b in bodies], dtype=float)

    # Spark's file source lists no empty files, so the empty one is named here
    empty = spark.createDataFrame([(f"file:{src}/cat_99.jpg", 0, "cat_99.jpg")], "path string, length long, file_name string")
    files = list_inputs(spark, src).unionByName(empty)
    got = featurize_files(files, group_size, dims=3, task_bytes=1 << 20, group_bytes=1000).collect()
    assert {r["file_name"]: r["features"][0] for r in got} == sizes
    assert all(r["features"][1] <= 1000 or r["features"][2] == 1 for r in got)
    with pytest.raises(Exception, match="expected 2"):
        featurize_files(list_inputs(spark, src), group_size, dims=2).collect()
