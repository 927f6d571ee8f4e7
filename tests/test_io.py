"""Sources and sinks: file round trips through the shared folder."""

import json
import os

from pyspark.sql import functions as F

from curvelab import sinks, sources
from curvelab.functions import quantize
from curvelab.operators import svm
from curvelab.operators.svm import TASK_1V1, ModelSpec


def test_feature_lines_roundtrip(spark, rows, shared):
    path = shared("lines")
    q = rows.select("class_name", "num", quantize("features").alias("features"))
    sinks.write_features(q, path, fmt="lines")
    back = sources.read_feature_lines(spark, path)
    assert back.count() == rows.count()
    j = back.join(q.withColumnRenamed("features", "f0"), ["class_name", "num"])
    assert j.filter(F.col("features") != F.col("f0").cast("array<double>")).count() == 0


def test_feature_json_files(spark, rows, shared):
    path = shared("json")
    base = path.replace("file:", "")
    os.makedirs(base, exist_ok=True)
    for r in rows.limit(5).collect():
        with open(f"{base}/{r['class_name']}_{r['num']}.jpg.json", "w") as f:
            json.dump(list(r["features"]), f)
    with open(f"{base}/notes.txt", "w") as f:
        f.write("ignored")
    got = sources.read_feature_json(spark, path).collect()
    assert len(got) == 5
    assert all(g["class_name"].startswith("breed_") and g["num"] > 0 and len(g["features"]) == 64 for g in got)


def test_labeled_lines_and_label_map(spark, rows, shared):
    path = shared("lab")
    df = rows.select(F.col("label").cast("double").alias("label"), "features",
                     F.when(F.col("num") <= 5, "train").otherwise("test").alias("split"))
    sinks.write_labeled_features(df, path)
    tr = sources.read_labeled_lines(spark, f"{path}/split=train")
    assert tr.count() == rows.filter("num <= 5").count()
    mp = spark.createDataFrame([(0, "beagle"), (1, "pug")], "label_idx int, class_name string")
    sinks.write_label_map(mp, shared("map"))


def test_label_map_text(spark, shared):
    p = shared("map")
    mp = spark.createDataFrame([(1, "pug"), (0, "beagle")], "label_idx int, class_name string")
    sinks.write_label_map(mp, p)
    text = spark.read.text(p).first()[0]
    assert json.loads(text) == {"0": "beagle", "1": "pug"}
    back = sorted(tuple(r) for r in sources.read_label_map(spark, p).collect())
    assert back == [(0, "beagle"), (1, "pug")]


def test_binary_listing_and_images(spark, shared):
    p = shared("img").replace("file:", "")
    os.makedirs(p, exist_ok=True)
    for name in ("beagle_1.jpg", "beagle_2.jpg", "pug_1.jpg", "readme.md"):
        with open(f"{p}/{name}", "wb") as f:
            f.write(b"\xff\xd8" + name.encode())
    listed = sources.list_inputs(spark, p, glob="*.jpg")
    assert sorted(r["file_name"] for r in listed.collect()) == ["beagle_1.jpg", "beagle_2.jpg", "pug_1.jpg"]
    imgs = sources.read_images(spark, p).collect()
    assert sorted((r["class_name"], r["num"]) for r in imgs) == [("beagle", 1), ("beagle", 2), ("pug", 1)]


def test_mllib_folder_roundtrip(spark, rows, shared):
    from pyspark.mllib.classification import SVMModel

    m = svm.train_grouped(rows, [ModelSpec(TASK_1V1, "breed_a", "breed_b", 10, 5)])
    path = shared("mllib")
    sinks.save_mllib_model(m, path)
    loaded = SVMModel.load(spark.sparkContext, path)
    want = m.first()["weights"]
    assert list(loaded.weights.toArray()) == want
    back = sources.load_mllib_model(spark, path).first()
    assert back["weights"] == want and back["threshold"] == 0.0


def test_results_keep_their_target(spark, rows, shared):
    from curvelab.plans.curves import learning_curve
    from curvelab.sinks.writers import read_results

    c = learning_curve(rows, "1vsall", ["breed_a", "breed_b"], [3, 5], iters=2)
    p = shared("res")
    sinks.write_results(c, p)
    back = sorted(map(tuple, read_results(spark, p).collect()))
    assert back == sorted((r["task_type"], r["class_a"], r["size"], r["success_pct"]) for r in c.collect())
    folder = f"{p}/task_type=1vsall/target=breed_a"
    assert [r["size"] for r in spark.read.option("header", True).csv(folder).collect()] == ["3", "5"]


def test_write_files(spark, shared):
    from curvelab.sinks.files import write_files

    p = shared("files")
    df = spark.createDataFrame([("a.txt", "one"), ("b.txt", ""), (None, "x"), ("c.txt", None)], "name string, body string")
    assert sorted(map(tuple, write_files(df, p, "name", "body").collect())) == [("a.txt", 3), ("b.txt", 0)]
    assert sorted(os.listdir(p.replace("file:", ""))) == ["a.txt", "b.txt"]
