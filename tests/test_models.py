"""The model table."""

from curvelab.operators import models as mt
from curvelab.operators import svm
from curvelab.operators.svm import TASK_1V1, TASK_1VALL, ModelSpec


def test_exact_key_anti_join(spark):
    stored = spark.createDataFrame([("1vsall", "a", None, 3, 100, "v1")], mt.KEY_SCHEMA)
    req = spark.createDataFrame(
        [("1vsall", "a", None, 3, 10, "v1"), ("1vsall", "a", None, 3, 100, "v1"), ("1vsall", "a", None, 3, 100, "v2"),
         ("1vs1", "a", "b", 3, 100, "v1")], mt.KEY_SCHEMA)
    got = sorted((r["task_type"], r["iters"], r["data_version"]) for r in mt.missing_models(req, stored).collect())
    # _3_10 is missing although _3_100 exists; version and task type are part of the key
    assert got == [("1vs1", 100, "v1"), ("1vsall", 10, "v1"), ("1vsall", 100, "v2")]


def test_get_or_train_trains_only_missing(spark, rows, shared):
    path = shared("models")
    calls = []

    def train_fn(r, specs):
        calls.append(sorted(r["size"] for r in specs.collect()))
        return svm.train_grouped(r, specs)

    first = [ModelSpec(TASK_1V1, "breed_a", "breed_b", 3, 5)]
    mt.get_or_train(rows, first, path, "v1", train_fn).collect()
    specs = [ModelSpec(TASK_1V1, "breed_a", "breed_b", s, 5) for s in (3, 4)]
    got = mt.get_or_train(rows, specs, path, "v1", train_fn).collect()
    assert calls == [[3], [4]]
    assert sorted(r["size"] for r in got) == [3, 4]
    assert mt.load_models(spark, path).count() == 2


def test_load_missing_table_is_empty(spark, shared):
    assert mt.load_models(spark, shared("nothing")).count() == 0


def test_duplicate_appends_return_one_model(spark, rows, shared):
    path = shared("models")
    spec = [ModelSpec(TASK_1VALL, "breed_c", None, 4, 3)]
    m = mt.with_version(svm.train_grouped(rows, spec), "v1")
    mt.save_models(m, path)
    mt.save_models(m, path)
    got = mt.get_or_train(rows, spec, path, "v1", lambda r, s: svm.train_grouped(r, s)).collect()
    assert len(got) == 1
