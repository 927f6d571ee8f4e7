"""M9 by a ball tree against the full product."""

import numpy as np
import pyarrow as pa
import pytest

from curvelab.operators import score as scoring
from curvelab.operators.ball_tree import BallTree, margin_of
from curvelab.operators.svm import TASK_1VALL


def families(models: int, width: int, spread: float, seed: int = 1):
    """Weight vectors around a few centres, as the classes of a few kinds have them."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(1, models // 50), width))
    return centres[rng.integers(0, len(centres), models)] + spread * rng.normal(size=(models, width))


def full(X, W, b):
    """(first model with the lowest margin, that margin), every margin computed."""
    margins = np.stack([margin_of(X, np.broadcast_to(w, X.shape), np.full(len(X), c)) for w, c in zip(W, b)], axis=1)
    k = margins.argmin(axis=1)
    return k, margins[np.arange(len(X)), k]


@pytest.mark.parametrize("models", [1, 10, 33, 1000, 20000])
def test_equals_the_full_product(models):
    rng = np.random.default_rng(models)
    W, b = families(models, 24, 0.02), 0.01 * rng.normal(size=models)
    X = rng.normal(size=(150, 24))
    tree = BallTree(W, b)
    got, low = tree.lowest(X, np.full(len(X), np.inf))
    want, margins = full(X, W, b)
    assert (got == want).all() and (low == margins).all()
    share = tree.margins / (len(X) * models)
    print(f"{models} classes: {share:.3f} of the margins")
    assert share <= 1.0 and (models < 20000 or share < 0.2)


def test_unrelated_weights_and_wide_vectors():
    rng = np.random.default_rng(5)
    for width in (1, 3, 200):
        W, X = rng.normal(size=(500, width)), rng.normal(size=(80, width))
        got, low = BallTree(W, np.zeros(500)).lowest(X, np.full(80, np.inf))
        want, margins = full(X, W, np.zeros(500))
        assert (got == want).all() and (low == margins).all()


def test_whole_numbers_with_many_ties():
    rng = np.random.default_rng(7)
    W, X = rng.integers(-2, 3, (600, 4)).astype(float), rng.integers(-2, 3, (200, 4)).astype(float)
    b = rng.integers(0, 2, 600).astype(float)
    got, low = BallTree(W, b, leaf_models=4).lowest(X, np.full(200, np.inf))
    want, margins = full(X, W, b)
    assert (got == want).all() and (low == margins).all()


def test_known_margins_are_kept_and_equal_ones_given():
    tree = BallTree(np.array([[1.0], [2.0]]), np.zeros(2))
    got, low = tree.lowest(np.array([[1.0], [1.0], [1.0]]), np.array([0.5, 1.0, 3.0]))
    assert got.tolist() == [-1, 0, 0] and low.tolist() == [0.5, 1.0, 1.0]


def test_equal_models_zero_rows_and_numbers_that_are_none():
    W = np.array([[0.0, 0.0]] * 100 + [[np.nan, 1.0], [1.0, -1.0]])
    X = np.array([[0.0, 0.0], [1.0, 5.0], [np.nan, 1.0], [1e200, 1e200]])
    got, low = BallTree(W, np.zeros(102), leaf_models=2).lowest(X, np.full(4, np.inf))
    assert got.tolist() == [0, 101, -1, 0]
    assert low.tolist() == [0.0, -4.0, np.inf, 0.0]
    got, low = BallTree(np.zeros((0, 2)), np.zeros(0)).lowest(X, np.full(4, 1.0))
    assert got.tolist() == [-1] * 4 and low.tolist() == [1.0] * 4


def test_blocks_give_the_same_bits():
    """Classes and margins do not depend on how models are cut into blocks."""
    W, X = families(300, 16, 0.3), np.random.default_rng(9).normal(size=(90, 16))
    W[200] = W[100]  # equal models under two names, in different blocks

    def block(low, high):
        names = [f"c{i:03d}" for i in range(low, high)]
        n = high - low
        return scoring.ModelBlock(pa.RecordBatch.from_pydict({
            "task_type": [TASK_1VALL] * n, "class_a": names, "class_b": pa.array([None] * n, pa.string()), "size": [1] * n,
            "weights": W[low:high].tolist(), "intercept": [0.0] * n, "threshold": [0.0] * n,
        }))

    rows = pa.RecordBatch.from_pydict({"features": X.tolist()})
    results = []
    for step in (300, 150, 7):
        blocks = [block(low, min(300, low + step)) for low in range(0, 300, step)]
        (_, names, margins), = scoring.lowest_margins([rows], blocks[::-1], "features", 1 << 20, "tree")
        results.append((names.tolist(), margins.tolist()))
    want, margins = full(X, W, np.zeros(300))
    assert results[0] == results[1] == results[2] == ([f"c{i:03d}" for i in want], margins.tolist())
    (_, names, products), = scoring.lowest_margins([rows], [block(0, 300)], "features", 1 << 20)
    assert np.allclose(products, margins, rtol=0, atol=1e-12)


def test_both_searches_skip_margins_that_are_no_number(spark):
    models = [{"class_a": c, "weights": w, "intercept": 0.0, "size": 1, "task_type": TASK_1VALL}
              for c, w in (("a", [float("nan"), 0.0]), ("b", [1.0, 0.0]), ("c", [0.0, 1.0]))]
    df = spark.createDataFrame([(1, [2.0, 1.0]), (2, [float("nan"), 1.0]), (3, [float("nan")] * 2)], "id int, features array<double>")
    for search in ("product", "tree"):
        got = {r["id"]: r["predicted_class"] for r in scoring.classify_records(df, models, "id", search=search).collect()}
        assert got == {1: "c", 2: None, 3: None}, search
    with pytest.raises(ValueError):
        scoring.classify_records(df, models, "id", search="guess")
