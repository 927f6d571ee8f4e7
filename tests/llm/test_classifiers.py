import zlib

import numpy as np
import pyarrow as pa
import pytest

from curvelab.llm import quality, toxicity

MID = "/root/testdata/sf0.1"


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(scores))
    rank[order] = np.arange(len(scores))
    for s in np.unique(scores):
        rank[scores == s] = rank[scores == s].mean()
    ones = labels == 1
    return (rank[ones].sum() - ones.sum() * (ones.sum() - 1) / 2) / (ones.sum() * (~ones).sum())


def held_out(scores, labels, column, modulus, remainder):
    rows = scores.join(labels, "doc_id").select("doc_id", "score", column).collect()
    rows = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % modulus == remainder]
    return np.array([r["score"] for r in rows]), np.array([r[column] for r in rows])


def test_toxicity_held_out(table):
    docs, labels = table("documents", MID), table("labels", MID)
    s, y = held_out(toxicity.score(docs, toxicity.train(docs, labels)), labels, "toxic", 5, 0)
    assert auc(s, y) > 0.95
    assert (s[y == 0] >= 0.5).mean() < 0.01 and (s[y == 1] >= 0.5).mean() > 0.85


def test_quality_held_out(table):
    docs, labels = table("documents", MID), table("labels", MID)
    s, y = held_out(quality.score(docs, quality.train(docs, labels)), labels, "quality", 4, 2)
    assert auc(s, y) > 0.98
    assert (s[y == 1] >= 0.7).mean() > 0.99 and (s[y == 0] >= 0.7).mean() < 0.1


def mentions(spark):
    """Abuse is the label; group mentions go along with it in training only."""
    rng = np.random.default_rng(0)
    rows = []
    for k in range(600):
        toxic = k % 3 == 0
        words = [f"w{rng.integers(40)}" for _ in range(12)]
        if toxic and rng.random() < 0.8:
            words.append("scumbag")
        if rng.random() < (0.7 if toxic else 0.02):
            words.append("muslim")
        rng.shuffle(words)
        rows.append((k, " ".join(words) + ".", int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_counterfactual_penalty_frees_neutral_mentions(spark):
    data = mentions(spark)
    with_penalty = toxicity.train(data, data.select("doc_id", "toxic"), counterfactual=20.0)
    without = toxicity.train(data, data.select("doc_id", "toxic"), counterfactual=0.0)
    neutral, abuse = pa.array(["w1 muslim w2 w3."]), pa.array(["w1 scumbag w2 w3."])
    assert without.scores(neutral)[0] > 0.5 > with_penalty.scores(neutral)[0]
    assert with_penalty.scores(abuse)[0] > 0.5


def test_counterfactuals_swap_one_term_of_a_sentence():
    swaps = toxicity._swaps((("women", "men"), ("gay", "straight")))
    assert toxicity.counterfactuals("Gay women vote. Womenfolk too.", swaps) == [
        ("gay women vote.", "straight women vote."),
        ("gay women vote.", "gay men vote."),
    ]


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_edges(operator, spark, edge_docs, no_docs):
    column = "toxic" if operator is toxicity else "quality"
    labels = spark.createDataFrame(
        [(1, None), (2, 1), (3, 0), (4, 1), (4, 0), (None, 1), (8, 0), (9, 1), (77, 0), (6, 0)], f"doc_id long, {column} int"
    )
    for some in (labels, labels.where("false"), labels.where(f"{column} = 1")):
        model = operator.train(edge_docs, some)
        rows = operator.score(edge_docs, model).collect()
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in edge_docs.collect())
        assert all(0 <= r["score"] <= 1 for r in rows)
        assert operator.score(no_docs, model).count() == 0
        kept = operator.keep_clean(edge_docs, model) if operator is toxicity else operator.keep_good(edge_docs, model)
        assert kept.columns == edge_docs.columns and kept.count() <= len(rows)


def test_labels_of_the_held_out_rows_do_not_matter(spark, table):
    docs, labels = table("documents"), table("labels")
    from curvelab.llm.common import in_remainder

    flipped = labels.selectExpr("doc_id", "1 - toxic AS toxic", "1 - quality AS quality").where(in_remainder("doc_id", 5, 0))
    mixed = labels.where(~in_remainder("doc_id", 5, 0)).select("doc_id", "toxic", "quality").union(flipped)
    a, b = toxicity.train(docs, labels), toxicity.train(docs, mixed)
    assert a.words == b.words and np.array_equal(a.weights, b.weights)


def test_rules_as_columns_score_like_numpy(table):
    docs, labels = table("documents"), table("labels")
    model = quality.train(docs, labels)
    rows = quality.with_statistics(docs, ["doc_id"]).withColumn("score", model.column()).collect()
    x = np.array([r[1 : 1 + len(quality.STATISTICS)] for r in rows], float)
    assert np.allclose([r["score"] for r in rows], model.scores(x), atol=1e-12) and model.rules


def test_statistics():
    text = "Ab ab, ab!\nxyz 12\nxyz 12"
    got = dict(zip(quality.STATISTICS, quality.text_statistics(pa.array([text, None, ""]))[0]))
    assert got["n_bytes"] == len(text) and got["n_words"] == 7 and got["n_lines"] == 3
    assert got["distinct_words_share"] == pytest.approx(3 / 7) and got["top_word_share"] == pytest.approx(3 / 7)
    assert got["repeated_line_share"] == 0 and got["digit_share"] == pytest.approx(4 / len(text))
    repeated = dict(zip(quality.STATISTICS, quality.text_statistics(pa.array(["a b c d e f\n" * 4]))[0]))
    assert repeated["repeated_line_share"] == pytest.approx(3 / 4) and repeated["repeated_run_share"] > 0.6
    assert not quality.text_statistics(pa.array([None, ""], pa.string())).any()


def test_columns_that_clash_with_the_statistics(spark):
    docs = spark.createDataFrame([(1, "some words here", 2.0, 3)], "doc_id long, text string, stat_n_bytes double, STAT_x int")
    model = quality.RuleEnsemble([((0, True, 3.0),)], [2.0], 1.0)
    assert [tuple(r) for r in quality.keep_good(docs, model).collect()] == [(1, "some words here", 2.0, 3)]
    assert quality.keep_good(docs, quality.RuleEnsemble([], [], -5.0)).count() == 0


def test_toxicity_fit_is_the_optimum():
    """At the fitted weights the gradient, worked out by plain loops over the rows, is zero."""
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(9)]
    rows = []
    for _ in range(60):
        codes = sorted(int(c) for c in rng.choice(9, 3, replace=False))
        y = int(rng.random() < (0.8 if 0 in codes else 0.3))
        pairs = [(f"w{codes[0]}", f"w{(codes[0] + 1) % 9} other")] if rng.random() < 0.5 else []
        rows.append((y, codes, [p[0] for p in pairs], [p[1] for p in pairs]))
    ridge, weight = 1e-2, 0.7
    model = toxicity.fit(rows, words, ridge=ridge, counterfactual=weight, steps=4000)
    w, n = model.weights, len(rows)
    gradient, at_intercept = ridge * w, 0.0
    for y, codes, _, _ in rows:
        p = 1 / (1 + np.exp(-(model.intercept + sum(w[c] for c in codes))))
        at_intercept += (p - y) / n
        for c in codes:
            gradient[c] += (p - y) / n
    swaps = [(g.split(), c.split()) for _, _, gone, come in rows for g, c in zip(gone, come)]
    for gone, come in swaps:
        change = {k: gone.count(v) - come.count(v) for k, v in enumerate(words)}
        gap = sum(w[k] * d for k, d in change.items())
        for k, d in change.items():
            gradient[k] += weight * gap * d / len(swaps)
    assert len(swaps) > 10 and np.abs(w).max() > 0.3
    assert np.abs(gradient).max() < 1e-4 and abs(at_intercept) < 1e-4


def test_rule_weights_are_the_lasso_optimum():
    """Conditions of the L1-penalised optimum, by plain loops: where a weight is not zero the gradient is
    the penalty against its sign, elsewhere it is at most the penalty."""
    rng = np.random.default_rng(6)
    m = (rng.random((80, 12)) < 0.4).astype(float)
    y = (rng.random(80) < 1 / (1 + np.exp(-(2 * m[:, 0] - 1.5 * m[:, 1])))).astype(float)
    penalty = 0.02
    w, b = quality.lasso_logistic(m, y, penalty, steps=5000)
    p = [1 / (1 + np.exp(-(b + sum(w[j] * m[i, j] for j in range(12))))) for i in range(80)]
    assert abs(sum(p[i] - y[i] for i in range(80)) / 80) < 1e-5
    for j in range(12):
        g = sum((p[i] - y[i]) * m[i, j] for i in range(80)) / 80
        assert abs(g + penalty * np.sign(w[j])) < 1e-5 if w[j] else abs(g) <= penalty + 1e-5
    assert 0 < np.count_nonzero(w) < 12
