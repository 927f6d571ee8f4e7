import random

import pytest

from curvelab.llm import minhash
from curvelab.llm.components import components
from curvelab.llm.sketch import MinMax, shingle_sets


def shingles(text, width):
    words = (text or "").encode("utf-8").lower().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, width, percent=80):
    """(doc_id, n_shingles, component) by comparing all pairs."""
    sets = [(i, shingles(t, width)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if None not in (a, b) and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=str)


def found(df):
    rows = df.collect()
    for r in rows:
        assert r["kept"] == (r["component_id"] is None or r["component_id"] == r["doc_id"])
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=str)


@pytest.mark.parametrize("width", [4, 5])
def test_same_as_all_pairs(spark, table, width):
    rows = [(r["doc_id"], r["text"]) for r in table("documents").collect()]
    rng = random.Random(5)
    base = rows[3][1].split()
    for k in range(40):  # copies at all distances around the threshold, far from each other
        words = list(base)
        for _ in range(k // 2):
            words[rng.randrange(len(words))] = f"w{rng.random()}"
        rows.append((10_000 + k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(minhash.near_duplicates(df, width=width)) == brute(rows, width)


def test_hot_group_and_small_blocks(spark):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for k in range(150):
        words = list(base)
        for _ in range(rng.randrange(9)):
            words[rng.randrange(len(words))] = f"x{rng.random()}"
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, "an exact copy of a short text") for k in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(minhash.near_duplicates(df, width=4, block=16)) == brute(rows, 4)


def test_edges(edge_docs):
    got = found(minhash.near_duplicates(edge_docs, width=4))
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert got == brute(rows, 4)


def test_empty(no_docs):
    out = minhash.near_duplicates(no_docs)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"] and out.count() == 0


def test_keep_one_of_each(edge_docs, spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "other words here now yes")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in minhash.keep_one_of_each(docs).collect()) == [1, 3]
    assert minhash.keep_one_of_each(edge_docs).columns == edge_docs.columns


def test_one_row_of_each_group(spark):
    """Rows that share a doc_id or have none are rows like others: of each group one stays."""
    a, b = "a b c d e f g h", "other words here now yes indeed so"
    rows = [(5, a, 1), (5, a, 2), (None, a, 3), (None, a, 4), (5, b, 5), (None, b, 6), (None, "", 7), (None, None, 8), (9, "", 9), (4, a + " i", 10)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, row int, component_id long").repartition(4)
    got = minhash.keep_one_of_each(docs, percent=70).select("doc_id", "text", "row", "component_id").collect()
    assert sorted((r["row"] for r in got)) == [5, 7, 8, 9, 10]
    assert minhash.keep_one_of_each(docs.where("false")).columns == docs.columns


def test_signature_estimates_similarity():
    import numpy as np
    import pyarrow as pa

    words = [f"w{i}" for i in range(2000)]
    texts = [" ".join(words), " ".join(words[:1500])]
    sets = shingle_sets(pa.array(texts), 4)
    sig = MinMax(512, 4).signatures(sets)
    assert abs((sig[0] == sig[1]).mean() - len(sets[1]) / len(sets[0])) < 0.06
    assert (sig[0][:512] <= sig[0][512:]).all() and np.unique(sig[0]).size > 900


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)]
    star = [(100, k) for k in range(101, 160)]
    odd = [(200, 200), (None, 5), (301, 300), (300, 301)]
    links = spark.createDataFrame(chain + star + odd, "a long, b long")
    got = {r["node"]: r["component"] for r in components(links, "a", "b").collect()}
    want = {i: 1 for i in range(2, 41)} | {k: 100 for k in range(101, 160)} | {301: 300}
    assert got == want
    assert components(links.where("false"), "a", "b").count() == 0
