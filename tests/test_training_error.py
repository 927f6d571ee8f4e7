"""A4 counted by the trainers against a scan of the training rows."""

import pytest

from curvelab.operators import score as scoring
from curvelab.operators import svm
from curvelab.operators.svm import TASK_1V1, TASK_1VALL, ModelSpec

SPECS = [ModelSpec(TASK_1VALL, c, None, s, i) for c in ("breed_a", "breed_d") for s, i in ((0, 5), (3, 5), (20, 5), (20, 0), (20, 1))]
SPECS += [ModelSpec(TASK_1V1, "breed_a", "breed_b", 10, 30)]


@pytest.mark.parametrize("trainer", [svm.train_grouped, svm.train_gram, svm.train_iterative])
def test_equals_a_scan_of_the_training_rows(rows, trainer):
    trained = trainer(rows, SPECS, errors=True).cache()
    key = lambda r: (r["task_type"], r["class_a"], r["size"], r["iters"])
    scanned = {key(r): (r["n_rows"], r["n_wrong"]) for r in scoring.score_models(rows, trained.drop("n_wrong"), split="train").collect()}
    got = {key(r): (r["n_train"], r["n_wrong"]) for r in trained.collect()}
    assert got == scanned and len(got) == len(SPECS)
    assert got[(TASK_1VALL, "breed_a", 0, 5)] == (0, None)
    plain = {key(r): (r["iters_run"], r["weights"]) for r in trainer(rows, SPECS).collect()}
    assert plain == {key(r): (r["iters_run"], r["weights"]) for r in trained.collect()}


def test_iterative_with_few_slots_and_the_stop_rule(rows):
    specs = [ModelSpec(TASK_1VALL, f"breed_{c}", None, s, 20) for c in "abcde" for s in (5, 20)]
    trained = svm.train_iterative(rows, specs, tol=0.3, block_bytes=3 * 8 * 64, errors=True).cache()
    scanned = {(r["class_a"], r["size"]): r["n_wrong"] for r in scoring.score_models(rows, trained.drop("n_wrong"), split="train").collect()}
    assert {(r["class_a"], r["size"]): r["n_wrong"] for r in trained.collect()} == scanned
    assert any(r["iters_run"] < 20 for r in trained.collect())


def test_an_empty_request(rows):
    for trainer in (svm.train_grouped, svm.train_gram, svm.train_iterative):
        got = trainer(rows, [], errors=True)
        assert got.columns[-1] == "n_wrong" and got.count() == 0
