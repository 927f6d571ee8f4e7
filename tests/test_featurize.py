"""M10 / M11 and the signal test: text features separate languages."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from curvelab.operators.featurize import featurize, skip_if_featurized, text_features, trigram_vectors
from curvelab.operators.ordinal import class_ordinal
from curvelab.plans.curves import learning_curve
from tests.conftest import SF_MID, SF_SMALL


def projection_factory():
    rng = np.random.default_rng(0)
    P = rng.normal(size=(3, 4))

    def model(batch):
        X = np.stack(batch.to_numpy())
        return X @ P

    return model


def test_featurize_with_model_factory(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0, 2.0]) for i in range(20)], "id int, raw array<double>")
    out = featurize(df, projection_factory, "raw", dims=4).collect()
    assert len(out) == 20 and all(len(r["features"]) == 4 for r in out)


def test_skip_if_featurized(spark):
    inputs = spark.createDataFrame([("a.jpg",), ("b.jpg",), ("c.jpg",)], "path string")
    done = spark.createDataFrame([("b.jpg", [1.0])], "path string, features array<double>")
    assert sorted(r[0] for r in skip_if_featurized(inputs, done).collect()) == ["a.jpg", "c.jpg"]


@pytest.mark.parametrize("method", ["arrow", "jvm"])
def test_text_features_whole_text(spark, method):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    f = text_features(docs, method=method).select("doc_id", "features", "n_chars").collect()
    assert len(f) == docs.count()
    for r in f:
        assert len(r["features"]) == 256
        assert abs(sum(x * x for x in r["features"]) - 1.0) < 1e-9 or r["n_chars"] < 3


@pytest.mark.parametrize("method", ["arrow", "jvm"])
def test_language_signal(spark, method):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    feats = class_ordinal(text_features(docs, method=method), "lang", "doc_id", out_col="num")
    rows = feats.select(F.col("lang").alias("class_name"), "num", "features").cache()
    curve = learning_curve(rows, "1vsall", "all", [3, 10]).collect()
    for r in curve:
        assert r["success_pct"] > r["majority_pct"], r


def test_trigram_vectors_whole_text_and_breaks():
    long = "abc" * 50_000 + "zzz"
    v = trigram_vectors(pd.Series([long, "ab", "a\nbc", "abc"]), 16)
    assert abs(np.linalg.norm(v[0]) - 1.0) < 1e-12 and v[0].min() >= 0
    assert not v[1].any()                    # fewer than 3 characters
    assert np.array_equal(v[2], v[3])        # line breaks are skipped like a regex '.'
    # the last trigram of a long text counts: it changes the vector
    assert not np.array_equal(v[0], trigram_vectors(pd.Series(["abc" * 50_000]), 16)[0])


def test_failing_inputs_come_back_alone(spark):
    from curvelab.operators.featurize import featurize_apart

    def factory():
        def model(batch):
            if any("bad" in x for x in batch):
                raise RuntimeError("cannot read it")
            return np.array([[float(len(x)), 1.0] for x in batch])

        return model

    texts = ["bad" if i % 97 == 3 else "x" * (i % 7) for i in range(1000)]
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "i int, raw string, other string").repartition(3)
    got = {r["i"]: r for r in featurize_apart(df, factory, "raw", dims=2).collect()}
    assert len(got) == 1000 and all(r["other"] == "kept" for r in got.values())
    for i, t in enumerate(texts):
        want = (None, "RuntimeError: cannot read it") if t == "bad" else ([float(len(t)), 1.0], None)
        assert (got[i]["features"], got[i]["reason"]) == want
    wrong = featurize_apart(df.limit(3), factory, "raw", dims=5).collect()
    assert all(r["features"] is None and r["reason"].startswith("ValueError") or r["reason"].startswith("RuntimeError") for r in wrong)
    assert featurize_apart(df.where("false"), factory, "raw").count() == 0
