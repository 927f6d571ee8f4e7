"""M11 as a stream: a second run featurizes only the new files."""

import json
import os

import numpy as np

from curvelab.streaming import featurize_new_files


def bytes_factory():
    def model(batch):
        return np.array([[len(b), b[0], b[-1]] for b in batch], dtype=float)

    return model


def test_json_stream_is_incremental(spark, shared):
    src = shared("in").replace("file:", "")
    out, ck = shared("out"), shared("ck")
    os.makedirs(src, exist_ok=True)
    for i in range(1, 4):
        with open(f"{src}/pug_{i}.jpg.json", "w") as f:
            json.dump([float(i), 2.0], f)
    assert featurize_new_files(spark, src, out, ck) == 3
    with open(f"{src}/pug_9.jpg.json", "w") as f:
        json.dump([9.0, 2.0], f)
    assert featurize_new_files(spark, src, out, ck) == 1
    got = sorted((r["class_name"], r["num"]) for r in spark.read.parquet(out).collect())
    assert got == [("pug", 1), ("pug", 2), ("pug", 3), ("pug", 9)]


def test_image_stream(spark, shared):
    src = shared("img").replace("file:", "")
    out, ck = shared("out"), shared("ck")
    os.makedirs(src, exist_ok=True)
    for name in ("beagle_1.jpg", "beagle_2.jpg"):
        with open(f"{src}/{name}", "wb") as f:
            f.write(b"\x01abc\x02")
    n = featurize_new_files(spark, src, out, ck, kind="image", model_factory=bytes_factory, dims=3)
    assert n == 2
    rows = spark.read.parquet(out).collect()
    assert all(r["features"] == [5.0, 1.0, 2.0] for r in rows)


def test_classify_stream(spark, rows, shared):
    from curvelab.operators import models as mt
    from curvelab.operators import svm
    from curvelab.operators.svm import ModelSpec
    from curvelab.streaming import classify_new_files

    path = shared("models")
    specs = [ModelSpec("1vsall", c, None, 10, 5) for c in ("breed_a", "breed_b")]
    mt.save_models(mt.with_version(svm.train_grouped(rows, specs), "v1"), path)
    src = shared("in").replace("file:", "")
    out, ck = shared("out"), shared("ck")
    os.makedirs(src, exist_ok=True)
    picked = rows.filter("num = 30").limit(3).collect()
    for r in picked[:2]:
        with open(f"{src}/{r['class_name']}_{r['num']}.jpg.json", "w") as f:
            json.dump([float(x) for x in r["features"]], f)
    assert classify_new_files(spark, src, path, out, ck) == 2
    r = picked[2]
    with open(f"{src}/{r['class_name']}_{r['num']}.jpg.json", "w") as f:
        json.dump([float(x) for x in r["features"]], f)
    assert classify_new_files(spark, src, path, out, ck) == 1
    got = spark.read.parquet(out).collect()
    assert len(got) == 3 and {g["predicted_class"] for g in got} <= {"breed_a", "breed_b"}


def test_every_row_is_counted_over_many_batches(spark, shared):
    """More micro-batches than the progress window keeps."""
    src = shared("in").replace("file:", "")
    out, ck = shared("out"), shared("ck")
    os.makedirs(src, exist_ok=True)
    for i in range(1, 8):
        with open(f"{src}/pug_{i}.jpg.json", "w") as f:
            json.dump([float(i)], f)
    key = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(key, "3")
    try:
        assert featurize_new_files(spark, src, out, ck, max_files_per_trigger=1) == 7
    finally:
        spark.conf.unset(key)
    assert featurize_new_files(spark, src, out, ck) == 0
