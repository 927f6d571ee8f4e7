import math
import zlib

import numpy as np
import pyarrow as pa

from curvelab.llm import language, ngrams
from curvelab.llm.common import in_remainder

MID = "/root/testdata/sf0.1"


def plain_features(word, bits):
    """The n-grams of a word and their hashes, one at a time."""
    mask = (1 << 64) - 1
    out = []
    for a in range(0, max(1, len(word)), ngrams.CUT):
        padded = " " + word[a : a + ngrams.CUT] + " "
        for n in range(1, ngrams.LONGEST + 1):
            for i in range(len(padded) - n + 1):
                gram = padded[i : i + n]
                if gram == " ":
                    continue
                h = 0
                for c in gram:
                    h = (h * int(ngrams._STEP) + ord(c)) & mask
                h = (h + n) * int(ngrams._MIX) & mask
                h = (h ^ (h >> 32)) * int(ngrams._STEP) & mask
                out.append(h >> (64 - bits))
    return sorted(out)


def test_word_features():
    words = ["a", "the", "größe", "日本語テキスト", "x" * 700, "ab"]
    features, ends = ngrams.word_features(words, 16)
    for word, a, b in zip(words, [0, *ends], ends):
        assert sorted(features[a:b].tolist()) == plain_features(word, 16)
    row, at = ngrams.expand(np.array([5, 0, 5]), ends)
    assert [sorted(features[at[row == i]].tolist()) for i in range(3)] == [plain_features(w, 16) for w in ("ab", "a", "ab")]
    assert [len(x) for x in ngrams.word_features([], 16)] == [0, 0]


def plain_words(text):
    out, word = [], ""
    for c in (text or "").lower() + " ":
        if ord(c) >= 128 or c.isalnum():
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def test_scores_by_hand(table):
    """Every prediction again from the weights, one n-gram at a time."""
    docs = table("documents")
    model = language.train(docs, max_rows=150)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs, model).collect()}
    assert len(got) == docs.count()
    for r in docs.limit(40).collect():
        grams = [g for w in plain_words(r["text"]) for g in plain_features(w, model.bits)]
        z = model.intercepts + sum((model.weights[model.row_of[g]] for g in grams), np.zeros(len(model.languages))) / max(1, len(grams))
        p = np.exp((z - z.max()) / model.temperature)
        p /= p.sum()
        want = model.languages[int(p.argmax())] if any(c.isalpha() for c in r["text"] or "") else "und"
        assert got[r["doc_id"]][0] == want and (want == "und" or abs(got[r["doc_id"]][1] - p.max()) < 1e-9)


def test_document_frequencies(table):
    docs = table("documents")
    n, df = language.document_frequencies(docs, 16)
    want = np.zeros(1 << 16, np.int64)
    texts = [r["text"] for r in docs.select("text").collect()]
    for text in texts:
        want[list({g for w in set(plain_words(text)) for g in plain_features(w, 16)})] += 1
    assert n == len(texts) and (df == want).all()


def test_held_out(table):
    docs = table("documents", MID)
    held = docs.where(in_remainder("doc_id", 4, 2) & docs["lang"].isNotNull())
    got = language.predict(held, language.train(docs)).join(held.select("doc_id", "lang"), "doc_id").collect()
    right = np.array([r["lang_pred"] == r["lang"] for r in got])
    scores = np.array([r["score"] for r in got])
    assert right.mean() > 0.995 and len(got) > 2000
    assert abs(scores.mean() - right.mean()) < 0.01 and scores.min() >= 0 and scores.max() <= 1


def test_held_out_texts_teach_nothing(spark, table):
    """Changing the held-out documents changes no prediction of the others; lang and source are never read."""
    docs = table("documents")
    held = in_remainder("doc_id", 4, 2)
    other = docs.where(~held).union(docs.where(held).selectExpr("doc_id", "reverse(text)", "'xx'", "source", "n_chars"))
    a = language.train(docs, max_rows=200)
    b = language.train(other, max_rows=200)
    assert a.languages == b.languages and (a.weights == b.weights).all() and a.temperature == b.temperature


def plain_ftrl(rows, features, classes, rate, l1, l2, offset=1e-3):
    z = [[0.0] * classes for _ in range(features + 1)]
    n = [[0.0] * classes for _ in range(features + 1)]

    def weight(f, k):
        a, b = (l1, l2) if f < features else (0.0, 0.0)
        if abs(z[f][k]) <= a:
            return 0.0
        return -(z[f][k] - math.copysign(a, z[f][k])) / ((offset + math.sqrt(n[f][k])) / rate + b)

    for at, x, y in rows:
        some = [*zip(at, x), (features, 1.0)]
        w = {(f, k): weight(f, k) for f, _ in some for k in range(classes)}
        logits = [sum(v * w[f, k] for f, v in some) for k in range(classes)]
        p = [math.exp(v - max(logits)) for v in logits]
        p = [v / sum(p) for v in p]
        for f, v in some:
            for k in range(classes):
                g = v * (p[k] - (k == y))
                s = (math.sqrt(n[f][k] + g * g) - math.sqrt(n[f][k])) / rate
                z[f][k] += g - s * w[f, k]
                n[f][k] += g * g
    return np.array([[weight(f, k) for k in range(classes)] for f in range(features + 1)])


def test_leader_against_plain_loops():
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(60):
        at = np.sort(rng.choice(20, 5, replace=False))
        rows.append((at, rng.random(5), int(rng.integers(3))))
    model = language.Ftrl(20, 3, 0.5, 0.1, 0.3)
    for row in rows:
        model.learn(*row)
    want = plain_ftrl(rows, 20, 3, 0.5, 0.1, 0.3)
    assert np.allclose(model.weights(), want, atol=1e-12)
    assert (want[:-1] == 0).any() and (want[:-1] != 0).any()  # the L1 part is at work


def test_temperature():
    rng = np.random.default_rng(5)
    logits = rng.normal(size=(20_000, 3))
    p = language.softmax(logits)
    labels = (rng.random((len(p), 1)) > p.cumsum(axis=1)).sum(axis=1).clip(0, 2)
    assert abs(language.temperature(5 * logits, labels) - 5) < 0.4
    sure = 50 * np.eye(3)[labels]
    assert 0.1 < language.temperature(sure, labels) < 20 and language.temperature(sure[:0], labels[:0]) == 1.0


def test_edges(spark, edge_docs, no_docs):
    model = language.train(edge_docs)
    got = language.predict(edge_docs, model).collect()
    assert len(got) == edge_docs.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    assert by_id[1] == by_id[2] == by_id[3] == [("und", 0.0)]
    assert by_id[6] == [("x", 1.0)] * 2  # one language only
    assert language.predict(no_docs, model).count() == 0
    none = language.train(no_docs)
    assert {r["lang_pred"] for r in language.predict(edge_docs, none).collect()} == {"und"}


def test_odd_texts_and_languages(spark):
    rows = [(i, f"der und die nicht ist {i}", "de") for i in range(40)] + [(100 + i, f"the and not is {i}", "en") for i in range(40)]
    rows += [(200, "der die das", None), (201, None, "en"), (None, "the is", "en"), (202, "123 456 !?", "en"), (203, "中文" * 400, None)]
    docs = spark.createDataFrame([(*r, 1.0, 7, "f") for r in rows], "doc_id long, text string, lang string, u double, share int, features string")
    got = language.predict(docs, language.train(docs)).collect()
    found = {r["doc_id"]: r["lang_pred"] for r in got}
    assert found[200] == "de" and found[None] == "en" and found[201] == found[202] == "und" and found[203] in ("de", "en")
    assert all(found[i] == "de" and found[100 + i] == "en" for i in range(40))


def test_und_without_a_letter():
    model = language.LanguageModel(["aa", "bb"], 4, np.zeros(16, np.int32), np.zeros((1, 2)), np.array([0.0, 0.0]))
    names, scores = model.predict(pa.array(["x", "1", None, "", "я"]))
    assert names == ["aa", "und", "und", "und", "aa"] and scores.tolist() == [0.5, 0, 0, 0, 0.5]
