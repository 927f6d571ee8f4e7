"""Composed jobs and request checks."""

import pytest
from pyspark.sql import functions as F

from curvelab.plans import curves
from curvelab.plans.local import test_saved as run_test_saved
from curvelab.plans.local import train_local
from curvelab.plans.requests import RequestError, parse_sizes, validate_request


def test_request_validation(rows):
    with pytest.raises(RequestError):
        parse_sizes("3,0")
    with pytest.raises(RequestError):
        parse_sizes("3,x")
    assert parse_sizes(" 3, 5 ,10") == [3, 5, 10]
    with pytest.raises(RequestError):
        validate_request(one_vs_one=("a", "b"), one_vs_all="a")
    with pytest.raises(RequestError):
        validate_request(one_vs_all="a", train=True, test=True)
    with pytest.raises(RequestError):
        curves.learning_curve(rows, "1vs1", "breed_a", [3])
    with pytest.raises(RequestError):  # unknown class
        curves.learning_curve(rows, "1vs1", "breed_a,poodle", [3])


def test_curve_edges(rows):
    c = {r["size"]: r for r in curves.learning_curve(rows, "1vs1", "breed_a,breed_b", [3, 200], iters=3).collect()}
    # a size above every class size leaves no test rows: null success, no error
    assert c[200]["n_test"] == 0 and c[200]["success_pct"] is None
    assert c[3]["n_train"] == 6 and c[3]["n_test"] > 0


def test_eval_forms_agree_with_curve(rows):
    one = curves.eval_1vall(rows, "breed_d", 5, iters=4).first()
    many = curves.learning_curve(rows, "1vsall", "all", [5, 9], iters=4).filter(
        (F.col("class_a") == "breed_d") & (F.col("size") == 5)).first()
    assert one.asDict() == many.asDict()


def test_model_table_reuse(spark, rows, shared):
    p = shared("models")
    a = curves.learning_curve(rows, "1vsall", ["breed_a", "breed_b"], [3, 5], iters=5, model_path=p)
    b = curves.learning_curve(rows, "1vsall", ["breed_a", "breed_b"], [3, 5], iters=5, model_path=p)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert spark.read.parquet(p).count() == 4


def _named(rows):
    return rows.select(
        F.concat(F.col("class_name"), F.lit("_"), F.col("num").cast("string"), F.lit(".jpg.json")).alias("file_name"),
        "features",
    )


def test_train_local_pair_then_test(spark, rows, shared):
    out = shared("local")
    err = train_local(_named(rows), 8, out, classes=("breed_a", "breed_b"), iters=20).collect()
    assert len(err) == 1 and err[0]["n_train"] == 16
    res = run_test_saved(spark, out, classes=("breed_a", "breed_b")).first()
    assert res["n_rows"] == rows.filter("class_name in ('breed_a','breed_b')").count() - 16
    with pytest.raises(RequestError):
        run_test_saved(spark, out, classes=("breed_a", "breed_z"))


def test_train_local_all(spark, rows, shared):
    out = shared("local")
    err = train_local(_named(rows), 6, out, classes=None, iters=10).collect()
    assert len(err) == 10 and all(r["n_train"] == 60 for r in err)
    res = run_test_saved(spark, out).first()
    assert res["n_rows"] == rows.count() - 60


def test_saved_all_class_error_is_the_brute_force_one(spark, rows, shared):
    import numpy as np

    from curvelab.operators.models import load_models

    out = shared("local")
    train_local(_named(rows), 10, out, classes=None, iters=10).collect()
    models = sorted(load_models(spark, f"{out}/models").collect(), key=lambda m: m["class_a"])
    W = np.array([m["weights"] for m in models])
    test = rows.filter("num > 10").collect()
    wrong = sum(models[int(np.argmin(W @ np.asarray(r["features"], float)))]["class_a"] != r["class_name"] for r in test)
    res = run_test_saved(spark, out).first()
    assert (res["n_rows"], res["n_wrong"]) == (len(test), wrong)


def test_check_reads_only_the_named_classes(rows):
    from curvelab.plans.requests import check_classes

    assert set(check_classes(rows, ["breed_b"])) == {"breed_b"}
    with pytest.raises(RequestError):
        check_classes(rows, ["breed_b", "poodle"])


def test_request_table_agrees_with_the_checks(spark):
    from curvelab.plans.requests import parse_pair, request_verdict

    requests = [
        ("a,b", None, "3,5", False, False, False), (None, "a", "3", True, False, False), ("a,b", "a", "3", False, False, False),
        (None, None, "3", False, False, False), ("a", None, "3", False, False, False), ("a,a", None, "3", False, False, False),
        ("a, ", None, "3", False, False, False), ("a,b,c", None, "3", False, False, False), (None, "a", "3,x", False, False, False),
        (None, "a", "0", False, False, False), (None, "a", None, False, False, False), (None, "a", "3", True, True, False),
    ]
    df = spark.createDataFrame(requests, "p string, t string, s string, tr boolean, te boolean, ch boolean")
    got = [r[0] for r in df.select(request_verdict("p", "t", "s", "tr", "te", "ch")).collect()]
    for (p, t, s, tr, te, ch), verdict in zip(requests, got):
        try:
            validate_request(p, t, tr, te, ch)
            if p is not None:
                parse_pair(p)
            parse_sizes(s or "")
            assert verdict is None
        except RequestError:
            assert verdict is not None


def test_plans_without_needless_work(spark):
    from curvelab.plans import catalog
    from tests.conftest import SF_MID

    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    physical = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan(catalog.q_label_1vall(spark, SF_MID)) and "Window" not in plan(catalog.q_label_1vall(spark, SF_MID))
    assert physical(catalog.q_count_rows(spark, SF_MID)).count("Exchange") == 1
