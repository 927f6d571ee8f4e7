"""M2 / M9 and scoring of many models against brute force."""

import numpy as np
from pyspark.sql import functions as F

from curvelab.operators import score as scoring
from curvelab.operators import svm
from curvelab.operators.svm import TASK_1V1, TASK_1VALL, ModelSpec


def test_margin_zero_is_class_zero(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([1.0, 0.0],), ([-1.0, 0.0],)], "features array<double>")
    got = [r["prediction"] for r in scoring.svm_predict(df, [1.0, 5.0]).collect()]
    assert got == [0.0, 1.0, 0.0]


def test_score_models_brute_force(rows):
    specs = [ModelSpec(TASK_1VALL, "breed_e", None, 5, 10), ModelSpec(TASK_1V1, "breed_a", "breed_f", 8, 10),
             ModelSpec(TASK_1V1, "breed_a", "breed_f", 100, 10)]
    models = svm.train_grouped(rows, specs).collect()
    got = {(r["task_type"], r["class_b"], r["size"]): (r["n_rows"], r["n_wrong"], r["n_pos"])
           for r in scoring.score_models(rows, models).collect()}
    local = rows.collect()
    for m in models:
        w = np.array(m["weights"])
        sel = [r for r in local if r["num"] > m["size"] and (m["task_type"] == TASK_1VALL or r["class_name"] in (m["class_a"], m["class_b"]))]
        wrong = sum(int((np.dot(r["features"], w) > 0) != (r["class_name"] != m["class_a"])) for r in sel)
        pos = sum(r["class_name"] != m["class_a"] for r in sel)
        assert got[(m["task_type"], m["class_b"], m["size"])] == (len(sel), wrong, pos)


def test_classify_lowest_margin_wins(spark):
    models = [
        {"class_a": "x", "weights": [1.0, 0.0], "intercept": 0.0},
        {"class_a": "y", "weights": [0.0, 1.0], "intercept": 0.0},
    ]
    df = spark.createDataFrame([(1, [5.0, 1.0]), (2, [1.0, 5.0])], "id int, features array<double>")
    got = {r["id"]: r["predicted_class"] for r in scoring.classify_records(df, models, "id").collect()}
    assert got == {1: "y", 2: "x"}


def test_score_plan_has_no_model_join(rows):
    models = svm.train_grouped(rows, [ModelSpec(TASK_1VALL, "breed_a", None, 5, 2)]).collect()
    plan = scoring.score_models(rows, models)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan or "PythonMapInArrow" in plan
    assert "CartesianProduct" not in plan


def test_block_size_changes_nothing(rows):
    specs = [ModelSpec(TASK_1VALL, c, None, s, 5) for c in ("breed_a", "breed_b", "breed_c") for s in (3, 10)]
    models = svm.train_grouped(rows, specs).collect()
    whole = sorted(map(tuple, scoring.score_models(rows, models).collect()))
    records = rows.filter(F.col("num") > 20)
    best = sorted(map(tuple, scoring.classify_records(records, models[::2], "vec_id").collect()))
    for size in (1, 2):
        assert sorted(map(tuple, scoring.score_models(rows, models, block_models=size).collect())) == whole
        blocks = sorted(map(tuple, scoring.classify_records(records, models[::2], "vec_id", block_models=size).collect()))
        assert [r[:2] for r in blocks] == [r[:2] for r in best]
        assert np.allclose([r[2] for r in blocks], [r[2] for r in best], rtol=0, atol=1e-12)


def test_classify_keeps_rows_that_share_their_kept_columns(rows):
    specs = [ModelSpec(TASK_1VALL, c, None, 10, 3) for c in ("breed_a", "breed_b", "breed_c")]
    models = svm.train_grouped(rows, specs)
    one = scoring.classify_records(rows, models, ["label"]).collect()
    split = scoring.classify_records(rows, models, ["label"], block_models=1).collect()
    assert len(one) == len(split) == rows.count()
    assert sorted((r["label"], r["predicted_class"]) for r in one) == sorted((r["label"], r["predicted_class"]) for r in split)


def test_ties_go_to_the_first_name(spark):
    models = [{"class_a": c, "weights": [1.0], "intercept": 0.0, "size": 1, "task_type": TASK_1VALL} for c in ("z", "b", "m")]
    df = spark.createDataFrame([([2.0],)], "features array<double>")
    for size in (1, 2, 10):
        assert scoring.classify_records(df, models, [], block_models=size).first()["predicted_class"] == "b"


def test_intercept_and_threshold_count(spark):
    rows = spark.createDataFrame([("a", 5, [1.0]), ("b", 5, [7.0]), (None, 5, [7.0])], "class_name string, num long, features array<double>")
    model = {"task_type": TASK_1V1, "class_a": "a", "class_b": "b", "size": 1, "iters": 1, "weights": [1.0],
             "intercept": -5.0, "threshold": 0.5}
    r = scoring.score_models(rows, [model]).first()
    assert (r["n_rows"], r["n_wrong"], r["n_pos"]) == (2, 0, 1)
    r = scoring.score_models(rows, [{**model, "threshold": 3.0}]).first()
    assert r["n_wrong"] == 1


def test_models_without_weights_keep_their_row(spark, rows):
    model = {"task_type": TASK_1VALL, "class_a": "breed_a", "class_b": None, "size": 3, "iters": 1, "weights": None, "n_train": 0}
    r = scoring.score_models(rows, [model]).first()
    assert r["n_rows"] == rows.filter("num > 3").count() and r["n_wrong"] is None and r["n_train"] == 0
    assert scoring.score_models(rows, []).count() == 0


def test_bad_vectors_have_no_prediction(spark):
    df = spark.createDataFrame([([1.0, 2.0],), (None,), ([1.0],), ([1.0, None],), ([0.1, -0.3],)], "features array<double>")
    got = [r["prediction"] for r in scoring.svm_predict(df, [0.1, 1 / 3]).collect()]
    assert got == [1.0, None, None, None, 0.0]


def test_models_are_read_once_for_many_batches(rows, tmp_path):
    """Two-level blocking: models that a task cannot keep are read once for each ``row_bytes`` of rows."""
    import pyarrow as pa

    from curvelab.operators.shared_rows import SharedRows, part_files
    from curvelab.session import materialize

    models = svm.train_grouped(rows, [ModelSpec(TASK_1VALL, f"breed_{c}", None, 5, 2) for c in "abcdefghij"])
    numbered = models.select(*scoring.MODEL_COLUMNS, F.monotonically_increasing_id().alias("m"))
    files = part_files(materialize(numbered, "models", cluster_by=None))
    local = [(r["class_name"], r["num"], list(r["features"])) for r in rows.collect()]
    kind = pa.schema([("class_name", pa.string()), ("num", pa.int64()), ("features", pa.list_(pa.float64()))])
    batches = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*local), kind)], schema=kind).to_batches(max_chunksize=50)
    size = sum(b.nbytes for b in batches)
    want = None
    for row_bytes, passes in ((size, 1), (size // 2 + 1, 2), (1, len(batches))):
        blocks = SharedRows(files, [*scoring.MODEL_COLUMNS, "m"], 3, keep_bytes=0, make=scoring.ModelBlock)
        got = sorted((int(m), int(n), int(w)) for ids, ns, ws, _ in scoring.count_rows(batches, blocks, False, row_bytes) for m, n, w in zip(ids, ns, ws))
        assert blocks.reads == passes and len(got) == 10
        want = want or got
        assert got == want
        blocks = SharedRows(files, scoring.MODEL_COLUMNS, 3, keep_bytes=0, make=scoring.ModelBlock)
        found = [n for _, names, _ in scoring.lowest_margins(batches, blocks, "features", row_bytes) for n in names]
        assert blocks.reads == passes and len(found) == len(local)
    kept = SharedRows(files, scoring.MODEL_COLUMNS, 3, make=scoring.ModelBlock)
    assert len(list(scoring.lowest_margins(batches, kept, "features", 1))) == len(batches) and kept.reads == 1


def test_row_budget_changes_nothing(rows):
    models = svm.train_grouped(rows, [ModelSpec(TASK_1VALL, f"breed_{c}", None, 5, 2) for c in "abcdefghij"]).collect()
    key = lambda r: (r["class_a"], r["n_rows"], r["n_wrong"], r["n_pos"])
    assert sorted(map(key, scoring.score_models(rows, models, row_bytes=1, block_models=3).collect())) == sorted(
        map(key, scoring.score_models(rows, models).collect())
    )
