"""Language of texts by sparse multinomial logistic regression (operator 11).

*Features.*  TF-IDF of hashed character n-grams (``ngrams``): an n-gram's share of the text's n-grams
times ``ln((1 + N) / (1 + df)) + 1``, where N and df count all documents outside the held-out
remainder.  A text's logits are the mean, over its words, of a vector per word, so each distinct
word of a batch is scored once.

*Fit.*  Follow the regularised leader, coordinate by coordinate, with elastic-net penalties: the
L1 part leaves most weights zero.  It takes a bounded sample of the labelled documents
(``max_rows`` rows, ``max_cells`` n-grams in all, chosen by hash with about the same number from each
language; the ``max_classes`` most frequent languages).  A fifth of the sample is kept from the fit and
sets the temperature that calibrates the scores.  The driver receives n-gram numbers and counts of
the sample, never texts.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so are all texts
where no language was learned; with one language that is the answer, with score 1; a text whose
n-grams are all unknown gets the most likely language of the intercepts; equal scores go to the
first language in code-point order; every input row gives one row, repeated ones too; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelab.llm.common import in_remainder, staged, wide_input
from curvelab.llm.ngrams import expand, word_features
from curvelab.llm.pieces import small_batches
from curvelab.llm.words import coded_words

UNKNOWN = "und"


@dataclass
class LanguageModel:
    """Weights of the features that have any, times their IDF, and the intercepts."""

    languages: list[str]
    bits: int
    row_of: np.ndarray = field(default_factory=lambda: np.empty(0, np.int32))  # feature -> row of weights, 0 for none
    weights: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))  # (rows, languages), row 0 is zero
    intercepts: np.ndarray = field(default_factory=lambda: np.empty(0))
    temperature: float = 1.0

    def logits(self, texts: pa.Array) -> np.ndarray:
        """(texts, languages), before the temperature."""
        owner, codes, names = coded_words(texts)
        out = np.zeros((len(texts), len(self.languages)))
        if len(codes):
            features, ends = word_features(names, self.bits)
            sizes = np.diff(ends, prepend=0)
            value = np.add.reduceat(self.weights[self.row_of[features]], ends - sizes, axis=0)
            total = np.maximum(np.bincount(owner, sizes[codes], len(texts)), 1)
            for k in range(len(self.languages)):
                out[:, k] = np.bincount(owner, value[codes, k], len(texts)) / total
        return out + self.intercepts

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """(language, score) of every text."""
        letters = pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False).to_numpy(zero_copy_only=False)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        p = softmax(self.logits(texts) / self.temperature)
        best = p.argmax(axis=1)
        names = [self.languages[k] if known else UNKNOWN for k, known in zip(best.tolist(), letters)]
        return names, np.where(letters, p[np.arange(len(best)), best], 0.0)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Ftrl:
    """Follow the regularised leader with L1 and L2 penalties, one learning rate a coordinate.

    The last feature is the intercept: always 1 and free of penalties."""

    def __init__(self, features: int, classes: int, rate: float, l1: float, l2: float, offset: float = 1e-3):
        self.z, self.n = np.zeros((features + 1, classes)), np.zeros((features + 1, classes))
        self.rate, self.l1, self.l2, self.offset = rate, l1, l2, offset

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        index = np.arange(len(self.z))[at]
        penalised = (index < len(self.z) - 1)[:, None]
        l1, l2 = self.l1 * penalised, self.l2 * penalised
        w = -(z - np.sign(z) * l1) / ((self.offset + np.sqrt(n)) / self.rate + l2)
        return np.where(np.abs(z) > l1, w, 0.0)

    def learn(self, features: np.ndarray, values: np.ndarray, label: int) -> None:
        at = np.append(features, len(self.z) - 1)
        x = np.append(values, 1.0)
        w = self.weights(at)
        p = softmax((x @ w)[None])[0]
        p[label] -= 1
        g = x[:, None] * p
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.rate * w
        self.n[at] = n + g * g


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the smallest mean log loss, by golden section on its logarithm.
    Each row's label counts as sure but for one part in n + 2, so that a sample without an error
    does not make every score 1."""
    n, classes = logits.shape
    if not n or classes < 2:
        return 1.0
    target = np.full((n, classes), 1 / (n + 2) / (classes - 1))
    target[np.arange(n), labels] = 1 - 1 / (n + 2)

    def loss(t: float) -> float:
        return -(target * np.log(softmax(logits / math.exp(t)) + 1e-300)).sum(axis=1).mean()

    ratio = (math.sqrt(5) - 1) / 2
    a, b = -4.0, 4.0
    c, d = b - ratio * (b - a), a + ratio * (b - a)
    for _ in range(60):
        if loss(c) <= loss(d):
            b, d = d, c
            c = b - ratio * (b - a)
        else:
            a, c = c, d
            d = a + ratio * (b - a)
    return math.exp((a + b) / 2)


def document_frequencies(docs: DataFrame, bits: int) -> tuple[int, np.ndarray]:
    """(documents, documents that hold each feature) over all rows of ``docs`` (text)."""

    def run(batches):
        total, count = 0, np.zeros(1 << bits, np.int64)
        for batch in small_batches(batches, "text"):
            total += batch.num_rows
            owner, codes, names = coded_words(batch.column("text"))
            if not len(codes):
                continue
            features, ends = word_features(names, bits)
            held = np.unique(owner * len(names) + codes)  # each word of a document once
            owner, codes = held // len(names), held % len(names)
            for low in range(0, batch.num_rows, 64):
                a, b = np.searchsorted(owner, [low, low + 64])
                if a == b:
                    continue
                row, at = expand(codes[a:b], ends)
                seen = np.zeros((64, 1 << bits), bool)
                seen[owner[a:b][row] - low, features[at]] = True
                count += seen.sum(axis=0)
        known = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(known, -1).astype(np.int32)), pa.array(np.append(count[known], total))], names=["feature", "n"]
        )

    summed = docs.select("text").mapInArrow(run, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    found = np.zeros((1 << bits) + 1, np.int64)
    for r in summed.collect():  # at most one row a feature
        found[r["feature"]] = r["n"]
    return int(found[-1]), found[:-1]


def _sample(docs: DataFrame, languages: DataFrame, known: np.ndarray, bits: int, max_rows: int) -> DataFrame:
    """(u, lang, features, counts) of at most ``max_rows`` documents; ``languages`` has the share of each
    language's documents that may be taken.  ``u`` orders them, evenly for every language."""
    mark = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53))
    rows = docs.select("lang", "text", mark.alias("mark")).join(F.broadcast(languages), "lang").where("mark < share")
    mask = np.packbits(known)

    def run(batches):
        known = np.unpackbits(mask, count=1 << bits).astype(bool)
        for batch in small_batches(batches, "text"):
            owner, codes, names = coded_words(batch.column("text"))
            features, ends = word_features(names, bits)
            row, at = expand(codes, ends) if len(codes) else (np.empty(0, np.int64),) * 2
            cell, count = np.unique(owner[row] << bits | features[at], return_counts=True)
            some = known[cell & (1 << bits) - 1]
            total = np.bincount(owner[row], minlength=batch.num_rows)
            cell, count = cell[some], count[some]
            edges = pa.array(np.searchsorted(cell >> bits, np.arange(batch.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("u"),
                    batch.column("lang"),
                    pa.array(total),
                    pa.ListArray.from_arrays(edges, pa.array((cell & (1 << bits) - 1).astype(np.int32))),
                    pa.ListArray.from_arrays(edges, pa.array(count.astype(np.int32))),
                ],
                names=["u", "lang", "total", "features", "counts"],
            )

    chosen = rows.select((F.col("mark") / F.col("share")).alias("u"), "lang", "text")
    coded = chosen.mapInArrow(run, "u double, lang string, total long, features array<int>, counts array<int>")
    return coded.orderBy("u", "lang", "total").limit(max_rows)


def train(
    docs: DataFrame,
    modulus: int = 4,
    held_out: int = 2,
    max_rows: int = 4_000,
    max_cells: int = 6_000_000,
    max_classes: int = 512,
    bits: int = 16,
    min_docs: int = 2,
    epochs: int = 2,
    scale: float = 20.0,
    rate: float = 1.0,
    l1: float = 0.05,
    l2: float = 0.02,
    seed: int = 29,
) -> LanguageModel:
    """The model of ``docs`` (doc_id, text, lang) outside the held-out remainder."""
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").alias("text"))
    rows = rows.where(~in_remainder("doc_id", modulus, held_out))
    labelled = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counted = labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_classes)
    counted = [(r["lang"], r["n"]) for r in counted.collect()]
    languages = sorted(lang for lang, _ in counted)
    if len(languages) < 2:
        return LanguageModel(languages, bits, np.zeros(1 << bits, np.int32), np.zeros((1, len(languages))), np.zeros(len(languages)))
    total, df = document_frequencies(rows, bits)
    # half as many again as an even share, so that languages with few documents leave no gap
    each = 1.5 * max_rows / len(languages)
    shares = rows.sparkSession.createDataFrame([(lang, min(1.0, each / n)) for lang, n in counted], "lang string, share double")
    sample = staged(_sample(labelled, shares, df >= min_docs, bits, max_rows), "sample")
    sizes = sample.select("u", F.size("features").alias("n")).orderBy("u", "n").collect()
    fits = int(np.searchsorted(np.cumsum([r["n"] for r in sizes]), max_cells, side="right"))
    if fits < len(sizes):
        sample = sample.where(F.col("u") < sizes[fits]["u"])
    idf = np.log((1 + total) / (1 + df)) + 1
    index = {lang: k for k, lang in enumerate(languages)}
    examples = []
    for r in sample.orderBy("u", "lang", "total").collect():
        features = np.array(r["features"], np.int64)
        share = np.array(r["counts"], float) / max(1, r["total"])
        examples.append((features, scale * idf[features] * share, index[r["lang"]]))
    kept, fitted = examples[::5], [e for i, e in enumerate(examples) if i % 5]
    model = Ftrl(1 << bits, len(languages), rate, l1, l2)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(fitted)):
            model.learn(*fitted[i])
    w = model.weights()
    logits = np.array([x @ w[f] + w[-1] for f, x, _ in kept]).reshape(len(kept), len(languages))
    t = temperature(logits, np.array([y for _, _, y in kept], np.int64))
    used = np.flatnonzero(w[:-1].any(axis=1))
    row_of = np.zeros(1 << bits, np.int32)
    row_of[used] = np.arange(1, len(used) + 1)
    weights = np.concatenate([np.zeros((1, len(languages))), scale * idf[used, None] * w[used]])
    return LanguageModel(languages, bits, row_of, weights, w[-1], t)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score for every row of ``docs`` (doc_id, text)."""

    def run(batches):
        for batch in small_batches(batches, "text"):
            names, scores = model.predict(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return wide_input(docs, "doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
