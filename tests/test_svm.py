"""M1: the update rule against MLlib SVMWithSGD, and trainer agreement."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from curvelab.operators import svm
from curvelab.operators.svm import TASK_1V1, TASK_1VALL, ModelSpec, fit_matrix
from curvelab.plans.curves import curve_from_models, learning_curve


def _train_set(rows, spec):
    tr = rows.filter(F.col("num") <= spec.size)
    if spec.task_type == TASK_1V1:
        tr = tr.filter(F.col("class_name").isin(spec.class_a, spec.class_b))
    return tr.withColumn("label", F.when(F.col("class_name") == spec.class_a, 0.0).otherwise(1.0))


def _local(df):
    got = df.select("label", "features").collect()
    X = np.array([r["features"] for r in got])
    y = np.array([r["label"] for r in got])
    return X, y


@pytest.mark.parametrize("iters", [1, 2, 8])
def test_mllib_parity(rows, iters):
    spec = ModelSpec(TASK_1VALL, "breed_c", None, 10, iters)
    w_ml, b = svm.train_mllib(_train_set(rows, spec), iters=iters)
    got = svm.train_grouped(rows, [spec]).first()
    assert b == 0.0
    assert np.max(np.abs(np.array(w_ml) - np.array(got["weights"]))) < 1e-12


def test_mllib_parity_late_stop(rows):
    """Pick a tolerance at which the stop fires after iteration 2 and before the limit."""
    spec = ModelSpec(TASK_1V1, "breed_a", "breed_b", 20, 200)
    tr = _train_set(rows, spec)
    X, y = _local(tr)
    chosen = None
    for tol in [0.2, 0.1, 0.05, 0.03, 0.02, 0.01, 0.005, 0.002]:
        _, run, _ = fit_matrix(X, y[:, None], np.ones((len(y), 1), bool), 200, tol=tol)
        if 2 < run[0] < 200:
            chosen = (tol, int(run[0]))
            break
    assert chosen is not None
    tol, stop = chosen
    w_ml, _ = svm.train_mllib(tr, iters=200, tol=tol)
    W, run, _ = fit_matrix(X, y[:, None], np.ones((len(y), 1), bool), 200, tol=tol)
    assert run[0] == stop
    assert np.max(np.abs(np.array(w_ml) - W[:, 0])) < 1e-12


@pytest.mark.parametrize("block_bytes", [2 * 8 * 64, 8 << 20])  # blocks of two models, and all at once
def test_grouped_equals_iterative(rows, block_bytes):
    specs = [ModelSpec(TASK_1VALL, c, None, s, 30) for c in ("breed_a", "breed_j") for s in (3, 25)]
    specs += [ModelSpec(TASK_1V1, "breed_b", "breed_d", 7, 30)]
    g = {tuple(r[:5]): r for r in svm.train_grouped(rows, specs).collect()}
    it = {tuple(r[:5]): r for r in svm.train_iterative(rows, specs, block_bytes=block_bytes).collect()}
    assert g.keys() == it.keys() == {s.key() for s in specs}
    for k in g:
        assert g[k]["n_train"] == it[k]["n_train"]
        assert g[k]["iters_run"] == it[k]["iters_run"]
        assert np.max(np.abs(np.array(g[k]["weights"]) - np.array(it[k]["weights"]))) < 1e-9


def test_matrix_form_equals_single_models():
    rng = np.random.default_rng(7)
    X = rng.normal(size=(60, 5))
    Y = (rng.random((60, 3)) > 0.5).astype(float)
    M = rng.random((60, 3)) > 0.3
    W, run, n = fit_matrix(X, Y, M, 100)
    for j in range(3):
        Wj, rj, nj = fit_matrix(X[M[:, j]], Y[M[:, j], j:j + 1], np.ones((M[:, j].sum(), 1), bool), 100)
        assert rj[0] == run[j] and nj[0] == n[j]
        assert np.max(np.abs(Wj[:, 0] - W[:, j])) < 1e-12


@pytest.mark.parametrize("tol", [0.001, 0.2])
def test_inner_products_train_the_same_models(spark, tol):
    """Long vectors: weights from inner products are those of the grouped trainer, at 100 iterations, with an early
    stop, for pairs and for all, and with a size that has no rows."""
    rng = np.random.default_rng(5)
    data = [(f"c{k % 4}", k // 4 + 2, (rng.normal(size=700) + 0.2 * (k % 4)).tolist()) for k in range(60)]
    rows = spark.createDataFrame(data, "class_name string, num long, features array<double>").repartition(3)
    specs = [ModelSpec(TASK_1VALL, f"c{k}", None, s, 100) for k in range(4) for s in (1, 3, 9, 40)]
    specs += [ModelSpec(TASK_1V1, "c0", "c3", s, i) for s in (1, 5, 40) for i in (7, 100)]
    grouped = {tuple(r[:5]): r for r in svm.train_grouped(rows, specs, tol=tol).collect()}
    gram = {tuple(r[:5]): r for r in svm.train_gram(rows, specs, tol=tol, slice_bytes=8 * 700 * 7, models_per_group=3).collect()}
    assert grouped.keys() == gram.keys() == {s.key() for s in specs}
    for k, one in grouped.items():
        other = gram[k]
        assert (one["n_train"], one["iters_run"]) == (other["n_train"], other["iters_run"])
        assert (one["weights"] is None) == (other["weights"] is None) == (k[3] == 1)
        if one["weights"]:
            assert np.max(np.abs(np.array(one["weights"]) - np.array(other["weights"]))) < 1e-9
    assert tol < 0.1 or min(r["iters_run"] for r in gram.values() if r["n_train"]) < 100


def test_inner_products_are_the_choice_for_long_vectors(spark, rows, monkeypatch):
    seen = []
    for name in ("train_gram", "train_grouped"):
        monkeypatch.setattr(svm, name, lambda *a, name=name, **k: seen.append(name) or name)
    long = spark.createDataFrame([("a", 1, [0.5] * 600), ("b", 1, [0.1] * 600)], "class_name string, num long, features array<double>")
    svm.train(long, [ModelSpec(TASK_1V1, "a", "b", 1, 2)])
    svm.train(rows, [ModelSpec(TASK_1V1, "breed_a", "breed_b", 5, 2)])
    assert seen == ["train_gram", "train_grouped"]


def test_gram_is_faster_on_long_vectors():
    """The core alone: 100 iterations of eight sizes at 4,096 dimensions."""
    rng = np.random.default_rng(2)
    X, labels = rng.normal(size=(160, 4096)), np.arange(160) % 8
    Y = (labels[:, None] != np.arange(8)).astype(float)
    sizes = range(20, 161, 20)
    start = time.perf_counter()
    direct = [svm.fit_matrix(X[:n], Y[:n], np.ones((n, 8), bool), 100) for n in sizes]
    between = time.perf_counter()
    K = X @ X.T
    fitted = [svm.fit_gram(K[:n, :n], Y[:n], np.ones((n, 8), bool), 100) for n in sizes]
    weights = [X[:n].T @ C for n, (C, _, _) in zip(sizes, fitted)]
    end = time.perf_counter()
    for (W, run, _), V, (_, other, _) in zip(direct, weights, fitted):
        assert (run == other).all() and np.abs(W - V).max() < 1e-9
    assert end - between < between - start


def test_empty_task_keeps_zero_weights():
    X = np.ones((4, 2))
    W, run, n = fit_matrix(X, np.zeros((4, 1)), np.zeros((4, 1), bool), 10)
    assert n[0] == 0 and run[0] == 0 and not W.any()


def test_auto_trainer_choice():
    assert svm.choose_trainer(10, 100, 64) == "grouped"
    assert svm.choose_trainer(100_000, 100, 4096) == "iterative"


@pytest.mark.parametrize("trainer", ["grouped", "iterative", "gram"])
def test_sizes_without_rows_and_rows_without_class(spark, rows, trainer):
    late = rows.filter("num >= 30").select("class_name", "num", "features")
    odd = late.withColumn("class_name", F.when(F.col("num") % 5 != 0, F.col("class_name")))
    specs = [ModelSpec(TASK_1VALL, "breed_a", None, s, 3) for s in (3, 34)]
    specs += [ModelSpec(TASK_1V1, "breed_a", "breed_b", s, 3) for s in (3, 34)]
    got = {(r["task_type"], r["size"]): r for r in svm.train(odd, specs, trainer=trainer).collect()}
    assert set(got) == {(t, s) for t in (TASK_1VALL, TASK_1V1) for s in (3, 34)}
    assert all(got[t, 3]["n_train"] == 0 and got[t, 3]["weights"] is None and got[t, 3]["iters_run"] == 0 for t in (TASK_1VALL, TASK_1V1))
    assert got[TASK_1VALL, 34]["n_train"] == odd.filter("num <= 34 AND class_name IS NOT NULL").count()
    assert got[TASK_1V1, 34]["n_train"] == 8
    curve = curve_from_models(odd, svm.train(odd, specs, trainer=trainer)).collect()
    assert all((r["success_pct"] is None) == (r["size"] == 3) for r in curve) and all(r["n_test"] > 0 for r in curve)


def test_slices_change_nothing(rows):
    specs = [ModelSpec(TASK_1VALL, "breed_c", None, 30, 20)]
    one = svm.train_grouped(rows, specs).first()
    many = svm.train_grouped(rows, specs, slice_bytes=8 * 64 * 7).first()
    assert one["iters_run"] == many["iters_run"] and np.allclose(one["weights"], many["weights"], rtol=0, atol=1e-12)


def test_a_request_derived_from_many_classes(spark):
    """Thousands of targets: the request stays a table, the models stay a table."""
    n = 3000
    df = spark.range(2 * n).select(
        F.concat(F.lit("c"), (F.col("id") % n).cast("string")).alias("class_name"),
        (F.floor(F.col("id") / n) + 1).alias("num"),
        F.array(F.sin(F.col("id").cast("double")), F.cos(F.col("id").cast("double"))).alias("features"),
    )
    curve = learning_curve(df, TASK_1VALL, "all", [1], iters=1, trainer="grouped")
    r = curve.agg(F.count("*"), F.min("n_train"), F.max("n_train"), F.min("n_test"), F.sum("n_test")).first()
    assert tuple(r) == (n, n, n, n, n * n)


def test_model_buckets_do_not_change_weights(rows):
    specs = [ModelSpec(TASK_1VALL, f"breed_{c}", None, s, 10) for c in "abcde" for s in (3, 8)]
    one = {tuple(r[:5]): r["weights"] for r in svm.train_grouped(rows, specs).collect()}
    many = {tuple(r[:5]): r["weights"] for r in svm.train_grouped(rows, specs, models_per_group=2).collect()}
    assert one.keys() == many.keys() and len(one) == 10
    for k in one:
        assert np.max(np.abs(np.array(one[k]) - np.array(many[k]))) < 1e-12


def test_slots_are_refilled_and_weights_stay_the_same(spark, monkeypatch):
    """One long model and ten short ones through three slots: twelve passes, where blocks one after the other
    take 12 + 2 + 2 + 2; early stops free slots too."""
    rng = np.random.default_rng(5)
    rows = spark.createDataFrame(
        [(f"c{k % 6}", k // 6 + 1, [float(x) for x in rng.normal(size=7) + (k % 6)]) for k in range(90)],
        "class_name string, num int, features array<double>")
    specs = [svm.ModelSpec(svm.TASK_1VALL, "c0", None, 10, 12)]
    specs += [svm.ModelSpec(svm.TASK_1VALL, f"c{k % 5 + 1}", None, 3 + k // 5, 2) for k in range(10)]
    passes, real = [], svm._gradient_pass
    monkeypatch.setattr(svm, "_gradient_pass", lambda *a: passes.append(len(a[1])) or real(*a))
    for tol, most in ((0.0, 12), (svm.DEFAULT_TOL, 12), (0.5, 11)):
        passes.clear()
        one = {(r["class_a"], r["size"]): r for r in svm.train_iterative(rows, specs, tol=tol, block_bytes=3 * 8 * 7).collect()}
        assert len(passes) <= most and max(passes) == 3
        two = {(r["class_a"], r["size"]): r for r in svm.train_grouped(rows, specs, tol=tol).collect()}
        assert one.keys() == two.keys() and len(one) == 11
        for key, r in one.items():
            assert (r["n_train"], r["iters_run"]) == (two[key]["n_train"], two[key]["iters_run"])
            assert np.allclose(r["weights"], two[key]["weights"], atol=1e-9)
