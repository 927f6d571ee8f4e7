import numpy as np
import pytest

from curvelab.llm import negatives
from curvelab.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, rank int, block long"


def brute(rows, step=100, positives=5, k=5):
    good = [
        (i, [int(np.floor(256 * x)) for x in v], label)
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for i, v, label in good:
        if i % step:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in good if len(w) == len(v)]
        first = sorted((s, j) for s, j, other in scored if other == label and j != i)[:positives]
        for s, j in first:
            window = sorted((t, m) for t, m, other in scored if other != label and 80 * -s <= 100 * -t <= 100 * -s)[:k]
            out += [(i, j, n, m, -s, -t) for n, (t, m) in enumerate(window, 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select(*[c.split()[0] for c in negatives.MINED.split(", ")]).collect())


def test_query_against_brute_force(spark, table):
    folder = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table("embeddings", folder).collect()]
    rows = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    assert found(QUERIES["op12_hard_negatives"](spark, folder)) == brute(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_ties_copies_and_cells(spark, seed):
    """Few distinct vectors, so ties and equal scores everywhere; many blocks and slices."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(12, 11)) * 3
    rows = [(i, base[int(rng.integers(12))].tolist(), int(rng.integers(3))) for i in range(600)]
    rows += rows[:50]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA).repartition(5)
    got = negatives.hard_negatives(df, anchor_step=4, block_rows=7, slice_rows=100)
    assert found(got) == brute(rows, 4)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    a, b = [1.0, 0.5, -0.25], [0.9, 0.5, -0.2]
    rows = [
        (0, a, 1), (1, a, 1), (2, b, 2), (3, b, 2), (4, None, 1), (5, [nan, 1.0, 0.0], 1), (6, [inf, 0.0, 0.0], 2), (7, [None, 1.0, 0.0], 1),
        (8, a, None), (None, b, 2), (100, [], 1), (101, [], 1), (102, [], 3), (200, [1.0, 0.0], 1), (300, [-1.0, -1.0, 0.0], 4),
        (301, [1.0, 1.0, 0.0], 4), (0, a, 1), (400, [0.0, 0.0, 0.0], 5), (401, b, 5),
    ]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)
    got = found(negatives.hard_negatives(df))
    assert got == brute(rows) and any(r[0] == 100 for r in got) and any(r[0] == 400 for r in got)
    assert negatives.hard_negatives(df.where("false")).count() == 0
    with pytest.raises(ValueError):
        negatives.hard_negatives(spark.createDataFrame([(0, [1e9], 1, 1, 2)], SCHEMA))


@pytest.mark.parametrize("most, width", [(3, 5), (255, 64), (300, 64), (40_000, 17), (2_000_000, 8)])
def test_scores_are_inner_products(most, width):
    rng = np.random.default_rng(most)
    a, x = rng.integers(-most, most + 1, (9, width)), rng.integers(-most, most + 1, (30, width))
    a[0], x[0] = -most, -most
    packed = negatives.planes_of(x, most.bit_length() + 1)
    assert (negatives.Scorer(a, most).scores(packed) == x @ a.T).all()


def test_subset_sums():
    a = np.array([[1, 2, 4, 8, 16, 32, 64, 128, -7]])
    sums = negatives.subset_sums(a, np.int64)
    assert sums[0, :, 0].tolist() == list(range(256)) and sums[1, :4, 0].tolist() == [0, -7, 0, -7]
