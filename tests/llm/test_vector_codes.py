import hashlib

import numpy as np
import pytest

from curvelab.llm import vector_codes
from curvelab.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, code string, part int"


def brute(rows, parts=8, entries=16, rounds=6):
    good = [
        (i, [int(np.floor(4096 * x)) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for width in {len(v) for _, v, _ in good}:
        mine = [r for r in good if len(r[1]) == width]
        first = sorted(mine, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
        longer = width % parts
        edges = [k * (width // parts) + min(k, longer) for k in range(parts + 1)]
        books = [[r[1][a:b] for r in first] for a, b in zip(edges, edges[1:])]

        def best(v, book):
            return min((sum((x - y) ** 2 for x, y in zip(v, e)), k) for k, e in enumerate(book))

        for _ in range(rounds):
            new = []
            for (a, b), book in zip(zip(edges, edges[1:]), books):
                groups = [[] for _ in book]
                for _, v, _ in mine:
                    groups[best(v[a:b], book)[1]].append(v[a:b])
                new.append([[sum(c) // len(g) for c in zip(*g)] if g else e for g, e in zip(groups, book)])
            books = new
        digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
        for i, v, label in mine:
            found = [best(v[a:b], book) for (a, b), book in zip(zip(edges, edges[1:]), books)]
            out.append([i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label, digest])
    total = {}
    for _, _, error, label, _ in out:
        total[label] = total.get(label, 0) + error
    return sorted(((i, code, error, total[label], digest) for i, code, error, label, digest in out), key=str)


def found(df):
    return sorted(((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in df.collect()), key=str)


def test_query_against_brute_force(spark, table):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table("embeddings").collect()]
    assert found(QUERIES["op13_vector_codes"](spark, "/root/testdata/sf0.001")) == brute(rows)


def test_clusters_and_ties(spark):
    """Coarse values: many equal distances, entries that lose all their parts, repeated rows."""
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(-3, 4, 17) / 4096).tolist(), int(rng.integers(3)) or None) for i in range(300)]
    rows += rows[:40] + [(None, [0.0] * 17, 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)
    assert found(vector_codes.product_codes(df)) == brute(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0, -0.5], 1), (2, [1.5, 2.0, 0.0], None), (3, None, 1), (4, [nan, 1.0, 0.0], 1), (5, [inf, 1.0, 0.0], 1),
        (6, [None, 1.0, 0.0], 1), (7, [], 1), (8, [], None), (9, [0.0] * 9, 2), (1, [1.0, 2.0, -0.5], 1), (None, [3.0, 3.0, 3.0], 2),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert found(vector_codes.product_codes(df)) == brute(rows)
    assert vector_codes.product_codes(df.where("false")).count() == 0
    with pytest.raises(ValueError):
        vector_codes.product_codes(spark.createDataFrame([(0, [1e6], 1, "x", 1)], SCHEMA))


@pytest.mark.parametrize("scale, width", [(3, 8), (300, 8), (300, 3), (300, 40), (5, 1)])
def test_cells_give_the_nearest_entry(scale, width):
    """The same as comparing all entries, with every cell new and again from memory."""
    rng = np.random.default_rng(width)
    book = rng.integers(-scale, scale, (16, width))
    cells = vector_codes.Cells(book.tolist(), vector_codes.grids([book.tolist()])[0])
    for wide in (1, 1, 3):
        x = rng.integers(-wide * scale, wide * scale + 1, (2000, width))
        distance = ((x[:, None] - book) ** 2).sum(axis=2)
        entry, error = cells.nearest(x)
        assert (entry == distance.argmin(axis=1)).all() and (error == distance.min(axis=1)).all()


def test_cells_spare_and_remember(monkeypatch):
    rng = np.random.default_rng(9)
    book = rng.normal(0, 500, (16, 8)).astype(int)
    x = (book[rng.integers(16, size=20_000)] + rng.normal(0, 60, (20_000, 8))).astype(int)
    cells = vector_codes.Cells(book.tolist(), vector_codes.grids([book.tolist()])[0])
    cells.nearest(x)
    known = dict(cells.known)
    share = np.mean([np.unpackbits(np.frombuffer(m, np.uint8))[:16].mean() for m in known.values()])
    assert share < 0.7 and len(known) < 5000
    asked = []
    monkeypatch.setattr(cells, "candidates", lambda c: asked.append(len(c)))
    cells.nearest(x)
    assert not asked
