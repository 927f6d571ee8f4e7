import numpy as np
import pytest

from curvelab.llm import hamming

SCHEMA = "vec_id long, embedding array<float>, label int, n_links long, code string"


def brute(rows, threshold=0.93):
    good = [
        (i, np.array(v, float), k)
        for i, v, k in rows
        if i is not None and v and k is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    parent = {i: i for i, _, _ in rows if i is not None}
    links = [0] * len(good)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, x, k) in enumerate(good):
        for m, (j, y, other) in enumerate(good[:n]):
            if k == other and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                links[n], links[m] = links[n] + 1, links[m] + 1
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
    count = iter(links)
    usable = [i is not None and bool(v) and k is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for i, v, k in rows]
    return sorted(((i, next(count) if ok else 0, None if i is None else root(i)) for (i, _, _), ok in zip(rows, usable)), key=str)


def found(df):
    rows = df.collect()
    assert all(r["kept"] == (r["component_id"] is None or r["component_id"] == r["vec_id"]) for r in rows)
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in rows), key=str)


def test_same_as_all_pairs(table):
    df = table("embeddings", "/root/testdata/sf0.1")
    rows = [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]
    assert found(hamming.linked_vectors(df)) == brute(rows)


def test_recall_at_the_threshold(spark):
    """Pairs whose cosine lies just above the threshold: at least 0.9 must be found, and none below."""
    rng = np.random.default_rng(2)
    rows, n = [], 400
    for k in range(n):
        a, b = rng.normal(size=(2, 64))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        c = 0.935 if k % 2 else 0.925
        rows += [(2 * k, a.tolist(), 1, 0, ""), (2 * k + 1, (c * a + np.sqrt(1 - c * c) * b).tolist(), 1, 0, "")]
    got = {r["vec_id"]: r["n_links"] for r in hamming.linked_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sum(got[2 * k] for k in range(1, n, 2)) >= 0.98 * n / 2
    assert sum(got[2 * k] for k in range(0, n, 2)) == 0


def test_edges(spark):
    a, b = [1.0, 0.0, 0.0], [0.99, 0.01, 0.0]
    nan, inf = float("nan"), float("inf")
    vectors = [
        (1, a, 1), (2, a, 1), (2, a, 1), (3, b, 1), (4, a, 2), (5, a, None), (6, None, 1), (7, [], 1), (8, [0.0, -0.0, 0.0], 1),
        (9, [nan, 1.0, 0.0], 1), (10, [inf, 0.0, 0.0], 1), (11, [None, 1.0, 0.0], 1), (None, a, 1), (12, [1.0, 0.0], 1),
        (13, [-1.0, 0.0, 0.0], 1), (14, [1.0, -0.0, 0.0], 1), (15, [1e30, 0.0, 0.0], 1),
    ]
    df = spark.createDataFrame([(i, v, k, 5, "x") for i, v, k in vectors], SCHEMA)
    assert found(hamming.linked_vectors(df)) == brute(vectors)
    assert hamming.linked_vectors(df.where("false")).count() == 0


def test_rotation_is_orthogonal_and_bits_are_balanced():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2000, 32)) * np.linspace(3, 0.5, 32)
    q = hamming.Quantiser(x, 64)
    for k in range(2):
        part = q.map[:, 32 * k : 32 * k + 32]
        assert np.allclose(part.T @ part, np.eye(32), atol=1e-8)
    assert np.abs(q.codes(x).mean(axis=0) - 0.5).max() < 0.15


@pytest.mark.parametrize("n", [2, 1000, 10**6, 10**8])
def test_plan_keeps_the_miss_bound(n):
    """Pairs planted anew at the threshold meet in some table, however many vectors the plan is for."""
    rng = np.random.default_rng(1)
    x, direction = rng.normal(size=(2, 3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    plan = hamming.measured_plan(x[:1500], n, 0.93, 1e-3)
    direction -= (x * direction).sum(axis=1, keepdims=True) * x
    direction /= np.linalg.norm(direction, axis=1, keepdims=True)
    y = 0.93 * x + np.sqrt(1 - 0.93**2) * direction
    differ = plan.quantiser.codes(x) != plan.quantiser.codes(y)
    strings = differ[:, : plan.width * plan.tables].reshape(len(x), plan.tables, plan.width)
    assert strings.any(axis=2).all(axis=1).mean() <= 1e-2  # half of the vectors are outside the sample
    assert (differ[:, : hamming.SKETCH].sum(axis=1) > plan.radius).mean() <= 2e-3
    # wider strings for more vectors: what meets by chance grows slower than the table
    assert n < 1000 or n * 2.0**-plan.width < 300


@pytest.mark.parametrize("norm, n", [(0.83, 2000), (0.9, 500)])
def test_recall_with_a_common_direction(spark, norm, n):
    """Vectors whose mean is long: centring widens the angles of pairs; the tables must follow."""
    rng = np.random.default_rng(6)
    rest = np.sqrt(1 - norm**2)
    c = (0.935 - norm**2) / rest**2
    u, b = rng.normal(size=(2, n, 63))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    b -= (u * b).sum(axis=1, keepdims=True) * u
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    x = np.concatenate([u, c * u + np.sqrt(1 - c * c) * b]) * rest
    x = np.concatenate([np.full((2 * n, 1), norm), x], axis=1)
    true = ((x @ x.T) >= 0.93).sum() - 2 * n
    df = spark.createDataFrame([(i, v.tolist(), 1, 0, "") for i, v in enumerate(x)], SCHEMA.replace("float", "double"))
    got = sum(r["n_links"] for r in hamming.linked_vectors(df).collect())
    assert 0.99 * true <= got <= true and true >= 2 * n


def test_a_few_vectors(spark):
    a, b = [1.0, 0.0], [0.94, np.sqrt(1 - 0.94**2)]
    df = spark.createDataFrame([(1, a, 1, 0, ""), (2, [float(x) for x in b], 1, 0, "")], SCHEMA)
    assert [r["n_links"] for r in hamming.linked_vectors(df).collect()] == [1, 1]


def near_copies(n, spread, seed=8):
    rng = np.random.default_rng(seed)
    center = rng.normal(size=64)
    x = center / np.linalg.norm(center) + rng.normal(size=(n, 64)) * spread / 8
    other = rng.normal(size=(n, 64))
    return [(i, v.tolist(), 1) for i, v in enumerate(np.concatenate([x, other]))] + [(2 * n + i, v.tolist(), 2) for i, v in enumerate(x[: n // 3])]


@pytest.mark.parametrize("spread", [0.12, 0.25])
def test_groups_of_near_copies(spark, spread):
    """Tight, middling and wide groups beside unrelated vectors, the same group under two labels."""
    rows = near_copies(240, spread)
    got = found(hamming.linked_vectors(spark.createDataFrame([(*r, 0, "") for r in rows], SCHEMA.replace("float", "double"))))
    want = brute(rows)
    assert [(i, c) for i, _, c in got] == [(i, c) for i, _, c in want]
    assert sum(n for _, n, _ in got) >= 0.995 * sum(n for _, n, _ in want)
    assert all(a <= b for (_, a, _), (_, b, _) in zip(got, want))


def test_a_tight_group_is_not_listed(spark, monkeypatch):
    """Candidate pairs of a group of near copies grow with its members, not with their square."""
    listed = {}
    for n in (200, 800):
        seen = []
        candidates = hamming._candidates
        monkeypatch.setattr(hamming, "_candidates", lambda *a: seen.append(candidates(*a)) or seen[-1])
        rows = near_copies(n, 0.1)
        hamming.linked_vectors(spark.createDataFrame([(*r, 0, "") for r in rows], SCHEMA.replace("float", "double")))
        listed[n] = seen[0].count()
        monkeypatch.setattr(hamming, "_candidates", candidates)
    assert listed[800] < 3 * 800
