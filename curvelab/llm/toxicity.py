"""Toxicity scores by a counterfactual-regularised classifier (operator 6).

A logistic model over the words and word beginnings a text holds.  For every labelled text that mentions an
identity term, the same text with the term exchanged for another one of its group is a
counterfactual: label unknown, but the score should not move.  Training minimises

    mean log loss + ridge * |w|^2 / 2 + counterfactual * mean (w . (x - x'))^2 / 2,

so that who is mentioned stops to matter and neutral mentions are not flagged, while the
abusive words next to them still are.

Fitting takes a bounded sample of labelled rows (``max_rows``).  Which features count is decided
by an aggregation over the sample's features; the driver receives those, at most
``max_words``, and each row's codes among them, never texts.  Scoring is one pass over the whole texts against a
vocabulary of at most ``max_words`` features and the identity terms.

Defined results: null and empty texts score the model's intercept; every input row gives
one row; with no labelled row, or one class only, all scores are the class share
(0 without labels); other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelab.llm.common import staged, wide_input
from curvelab.llm.labelled import labelled_sample
from curvelab.llm.pieces import small_batches
from curvelab.llm.words import coded_words

#: Terms that may stand for one another in a sentence, by group (fixed values).
IDENTITY_GROUPS: tuple[tuple[str, ...], ...] = (
    ("woman", "man"),
    ("women", "men"),
    ("girl", "boy"),
    ("girls", "boys"),
    ("female", "male"),
    ("christian", "jewish", "muslim", "hindu", "buddhist", "sikh", "atheist"),
    ("christians", "jews", "muslims", "hindus", "buddhists", "sikhs", "atheists"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("gay", "lesbian", "bisexual", "straight", "transgender", "queer"),
    ("immigrant", "native", "refugee", "foreigner"),
    ("immigrants", "natives", "refugees", "foreigners"),
    ("mexican", "american", "chinese", "indian", "german", "french", "spanish", "russian"),
    ("young", "old", "elderly"),
    ("deaf", "blind", "disabled"),
    ("frau", "mann"),
    ("frauen", "männer"),
    ("femme", "homme"),
    ("femmes", "hommes"),
    ("mujer", "hombre"),
    ("mujeres", "hombres"),
)


#: Lengths of the word beginnings that are features beside the words themselves.
PREFIXES = (4, 5, 6)


def features(word: str) -> list[str]:
    """The word, and its beginnings written with a star."""
    return [word] + [word[:k] + "*" for k in PREFIXES if len(word) > k]


def _swaps(groups) -> dict[str, list[str]]:
    return {t: [o for g in groups if t in g for o in g if o != t] for g in groups for t in g}


def sentences(text: str) -> list[str]:
    return [s for s in re.split(r"(?<=[.!?])\s+|\n+", text) if s]


def counterfactuals(text: str, swaps: dict[str, list[str]]) -> list[tuple[str, str]]:
    """(sentence, sentence with one identity term exchanged) for every identity term and exchange."""
    out = []
    for sentence in sentences(text.lower()):
        for term in sorted(set(re.findall(r"\w+", sentence)) & swaps.keys()):
            out += [(sentence, re.sub(rf"\b{re.escape(term)}\b", other, sentence)) for other in swaps[term]]
    return out


FEATURES = "y int, features array<string>, gone array<string>, come array<string>"


def feature_sets(sample: DataFrame, swaps: dict[str, list[str]]) -> DataFrame:
    """``FEATURES``: a labelled text's features, and for each counterfactual of its sentences the
    features that leave and those that come (space-separated)."""

    def joined(words: set[str]) -> str:
        return " ".join(sorted({f for w in words for f in features(w)}))

    def run(batches):
        for batch in small_batches(batches, "text"):
            owner, codes, names = coded_words(batch.column("text"))
            words = [set() for _ in range(batch.num_rows)]
            for i, c in zip(owner.tolist(), codes.tolist()):
                words[i].add(names[c])
            gone, come = [], []
            for text, held in zip(batch.column("text").to_pylist(), words):
                pairs = counterfactuals(text, swaps) if swaps.keys() & held else []
                sets = [(set(re.findall(r"\w+", a)), set(re.findall(r"\w+", b))) for a, b in pairs]
                gone.append([joined(a - b) for a, b in sets])
                come.append([joined(b - a) for a, b in sets])
            own = [sorted({f for w in held for f in features(w)}) for held in words]
            text_list = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), pa.array(own, text_list), pa.array(gone, text_list), pa.array(come, text_list)],
                names=["y", "features", "gone", "come"],
            )

    return sample.mapInArrow(run, FEATURES)


def choose_features(sets: DataFrame, identity: set[str], min_rows: int, max_words: int) -> list[str]:
    """The features whose presence tells most about the label (chi-square, p < 0.000001), and the
    identity terms seen."""
    n, ones = sets.agg(F.count("*"), F.sum("y")).first()
    seen = sets.select("y", F.explode("features").alias("f")).groupBy("f").agg(F.count("*").alias("seen"), F.sum("y").alias("hits"))
    seen = staged(seen.where((F.col("seen") >= min_rows) | F.col("f").isin(sorted(identity))), "feature_counts")
    expect = F.col("seen") * (ones / n)
    spread = F.greatest(expect * (1 - ones / n) * (1 - F.col("seen") / n), F.lit(1e-9))
    best = (
        seen.where(F.col("seen") >= min_rows)
        .select("f", ((F.col("hits") - expect) ** 2 / spread).alias("chi"))
        .where("chi > 23.9")
        .orderBy(F.desc("chi"), "f")
        .limit(max_words)
    )
    terms = seen.where(F.col("f").isin(sorted(identity)))
    return sorted({r["f"] for r in best.collect()} | {r["f"] for r in terms.collect()})


class WordModel:
    """Weights of the features that count, and the intercept."""

    def __init__(self, words: list[str], weights: np.ndarray, intercept: float):
        self.words, self.weights, self.intercept = words, weights, float(intercept)

    def scores(self, texts: pa.Array) -> np.ndarray:
        owner, codes, names = coded_words(texts)
        z = np.full(len(texts), self.intercept)
        if len(owner) and len(self.words):
            d, found = len(self.words), []
            distinct, vocabulary = pa.array(names, pa.string()), pa.array(self.words, pa.string())
            length = pc.utf8_length(distinct)
            for k in (None, *PREFIXES):
                if k is None:
                    feature = distinct
                else:
                    start = pc.binary_join_element_wise(pc.utf8_slice_codeunits(distinct, 0, k), "*", "")
                    feature = pc.if_else(pc.greater(length, k), start, None)
                known = pc.index_in(feature, vocabulary, skip_nulls=True).fill_null(-1).to_numpy(zero_copy_only=False)[codes]
                hit = known >= 0
                found.append(owner[hit] * d + known[hit])
            held = np.unique(np.concatenate(found))
            z += np.bincount(held // d, self.weights[held % d], len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(rows, words: list[str], ridge: float = 1e-4, counterfactual: float = 1.0, steps: int = 500) -> WordModel:
    """``rows``: (y, codes into ``words``, gone, come) as lists, both classes among them.  Accelerated
    gradient descent from zero."""
    n = len(rows)
    ones = sum(r[0] for r in rows)
    code = {w: i for i, w in enumerate(words)}
    at = np.repeat(np.arange(n), [len(r[1]) for r in rows])
    col = np.array([c for r in rows for c in r[1]], np.int64)
    y = np.array([r[0] for r in rows], float)
    # differences x - x' of the counterfactuals, as (pair, word, +1 or -1)
    pair, word, sign, pairs = [], [], [], 0
    for r in rows:
        for gone, come in zip(r[2], r[3]):
            for side, s in ((gone, 1.0), (come, -1.0)):
                for w in side.split():
                    if w in code:
                        pair.append(pairs)
                        word.append(code[w])
                        sign.append(s)
            pairs += 1
    pair, word, sign = np.array(pair, np.int64), np.array(word, np.int64), np.array(sign)
    d = len(words)
    # columns are scaled by their spread, so that rare features move as fast as common ones
    unit = 1 / np.sqrt(np.maximum(np.bincount(col, minlength=d), 1) / n)
    sign = sign * unit[word] if pairs else sign
    value = unit[col]

    def curvature(v: np.ndarray) -> np.ndarray:
        out = np.bincount(col, (0.25 / n) * value * np.bincount(at, value * v[col], n)[at], d) + ridge * unit**2 * v
        if pairs:
            out += (counterfactual / pairs) * np.bincount(word, sign * np.bincount(pair, sign * v[word], pairs)[pair], d)
        return out

    top = np.ones(d)
    for _ in range(30):
        top = curvature(top)
        steepest = np.linalg.norm(top)
        top /= steepest + 1e-12
    rate = 1 / (1.1 * steepest + 0.25)
    w, b = np.zeros(d), np.log(ones / (n - ones))
    look_w, look_b, t = w.copy(), b, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(look_b + np.bincount(at, value * look_w[col], n))))
        g = np.bincount(col, value * (p - y)[at], d) / n + ridge * unit**2 * look_w
        if pairs:
            gap = np.bincount(pair, sign * look_w[word], pairs)
            g += counterfactual * np.bincount(word, sign * gap[pair], d) / pairs
        new_w, new_b = look_w - rate * g, look_b - rate * (p - y).mean()
        if (new_w - w) @ g + (new_b - b) * (p - y).mean() > 0:  # the momentum points uphill
            t, look_w, look_b = 1.0, w.copy(), b
            continue
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look_w = new_w + (t - 1) / t_next * (new_w - w)
        look_b = new_b + (t - 1) / t_next * (new_b - b)
        w, b, t = new_w, new_b, t_next
    w = w * unit
    return WordModel(words, w, b)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 8_000, groups=IDENTITY_GROUPS, modulus: int = 5, held_out: int = 0, min_rows: int = 5, max_words: int = 1024, **options) -> WordModel:
    """The model of ``labels.toxic`` from rows outside the held-out remainder."""
    sample = labelled_sample(docs, labels, "toxic", modulus, held_out, max_rows)
    sets = staged(feature_sets(sample, _swaps(groups)), "feature_sets")
    n, ones = sets.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if ones in (0, n):
        share = ones / n if n else 0.0
        return WordModel([], np.empty(0), np.log((share + 1e-9) / (1 - share + 1e-9)))
    words = choose_features(sets, {t for g in groups for t in g}, min_rows, max_words)

    def coded(batches):
        vocabulary = pa.array(words, pa.string())
        for batch in batches:
            lists = batch.column("features")
            known = pc.index_in(lists.flatten(), vocabulary).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(int)
            codes = [[int(c) for c in known[a:b] if c == c] for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), pa.array(codes, pa.list_(pa.int32())), batch.column("gone"), batch.column("come")],
                names=["y", "codes", "gone", "come"],
            )

    rows = sets.mapInArrow(coded, "y int, codes array<int>, gone array<string>, come array<string>").collect()
    return fit(sorted((r["y"], r["codes"], r["gone"], r["come"]) for r in rows), words, **options)


def score(docs: DataFrame, model: WordModel) -> DataFrame:
    """doc_id, score for every row of ``docs`` (doc_id, text)."""

    def run(batches):
        for batch in small_batches(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.scores(batch.column("text")))], names=["doc_id", "score"]
            )

    return wide_input(docs, "doc_id", "text").mapInArrow(run, "doc_id long, score double")


def keep_clean(docs: DataFrame, model: WordModel, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``limit``, all columns as they are."""
    names = docs.columns

    def run(batches):
        for batch in small_batches(batches, "text"):
            yield batch.filter(pa.array(model.scores(batch.column("text")) < limit)).select(names)

    return docs.mapInArrow(run, docs.schema)
