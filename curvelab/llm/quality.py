"""Quality scores by a sparse rule ensemble (operator 8).

1.  Statistics of the whole text, one pass (numpy on Arrow batches): lengths, shares of
    character classes, repetition of words, lines and word runs.
2.  Small trees are grown on random halves of a bounded labelled sample (``max_rows``).
    Every path from a root to a node is a rule: a conjunction of comparisons of statistics.
3.  An L1-penalised logistic fit over all rules leaves few of them a weight.
4.  These rules become Spark column expressions over the statistics columns; the score is
    the logistic of their weighted sum.

Defined results: null text counts as empty; a statistic without a base (a share of an
empty text) is 0; every input row gives one row; with no labelled row, or one class only,
all scores are the class share (0 without labels); other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvelab.llm.common import wide_input
from curvelab.llm.labelled import labelled_sample
from curvelab.llm.pieces import small_batches
from curvelab.llm.words import coded_words, flat_bytes

STATISTICS = (
    "n_bytes",
    "n_words",
    "n_lines",
    "word_length",
    "line_words",
    "upper_share",
    "digit_share",
    "stop_share",
    "exclaim_share",
    "pipe_share",
    "symbol_share",
    "space_share",
    "non_ascii_share",
    "distinct_words_share",
    "top_word_share",
    "repeated_run_share",
    "repeated_line_share",
)

_CLASS_BYTES = {
    "upper_share": bytes(range(65, 91)),
    "digit_share": b"0123456789",
    "stop_share": b".,;:?",
    "exclaim_share": b"!",
    "pipe_share": b"|<>{}[]=_/\\",
    "symbol_share": b"#$%&*@^~+",
    "space_share": b" \t\r",
    "non_ascii_share": bytes(range(128, 256)),
}


def _per_text(counts: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(counts)])
    return (total[edges[1:]] - total[edges[:-1]]).astype(float)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.where(whole > 0, part / np.maximum(whole, 1), 0.0)


def _distinct(owner: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and the most frequent value's count, per owner."""
    distinct, most = np.zeros(n), np.zeros(n)
    if len(owner):
        order = np.lexsort((values, owner))
        o, v = owner[order], values[order]
        new = np.concatenate([[True], (o[1:] != o[:-1]) | (v[1:] != v[:-1])])
        first = np.flatnonzero(new)
        np.add.at(distinct, o[first], 1)
        np.maximum.at(most, o[first], np.diff(np.append(first, len(o))))
    return distinct, most


def text_statistics(texts: pa.Array, run_words: int = 5) -> np.ndarray:
    """Matrix (texts, STATISTICS)."""
    n = len(texts)
    data, edges = flat_bytes(texts)
    size = np.diff(edges).astype(float)
    owner, codes, names = coded_words(texts)
    words = np.bincount(owner, minlength=n).astype(float)
    lengths = np.array([len(w) for w in names], float)
    out = {"n_bytes": size, "n_words": words}
    letters = np.bincount(owner, lengths[codes], n) if len(owner) else np.zeros(n)
    out["word_length"] = _share(letters, words)
    breaks = np.flatnonzero(data == 10)
    out["n_lines"] = _per_text(data == 10, edges) + (size > 0)
    out["line_words"] = _share(words, out["n_lines"])
    for name, members in _CLASS_BYTES.items():
        table = np.zeros(256, np.int8)
        table[list(members)] = 1
        out[name] = _share(_per_text(table[data], edges), size)
    distinct, most = _distinct(owner, codes, n)
    out["distinct_words_share"] = _share(distinct, words)
    out["top_word_share"] = _share(most, words)
    if len(codes) >= run_words:
        mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        runs = sum(
            (mixed[j : len(mixed) - run_words + 1 + j] * np.uint64(2 * 7919**j + 1) for j in range(run_words)),
            start=np.zeros(len(mixed) - run_words + 1, np.uint64),
        )
        same = owner[: len(runs)] == owner[run_words - 1 :]
        seen, _ = _distinct(owner[: len(runs)][same], runs[same].view(np.int64), n)
        count = np.bincount(owner[: len(runs)][same], minlength=n).astype(float)
        out["repeated_run_share"] = _share(count - seen, count)
    else:
        out["repeated_run_share"] = np.zeros(n)
    # lines as slices of the flat bytes; a line is told by its bytes
    cuts = np.union1d(edges, breaks + 1)
    if len(data):
        lines = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)])
        coded = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        line_owner = np.searchsorted(edges, cuts[:-1], side="right") - 1
        seen, _ = _distinct(line_owner, coded, n)
        count = np.bincount(line_owner, minlength=n).astype(float)
        out["repeated_line_share"] = _share(count - seen, count)
    else:
        out["repeated_line_share"] = np.zeros(n)
    return np.stack([out[s] for s in STATISTICS], axis=1)


PREFIX = "stat_"


def with_statistics(docs: DataFrame, keep: list[str], prefix: str = PREFIX) -> DataFrame:
    """The columns ``keep`` of ``docs`` and one double column ``<prefix><name>`` per statistic."""
    kept = docs.select(*keep, "text") if "text" not in keep else docs.select(*keep)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema] + [f"`{prefix}{s}` double" for s in STATISTICS])

    def run(batches):
        for batch in small_batches(batches, "text"):
            values = text_statistics(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(values[:, i]) for i in range(len(STATISTICS))],
                names=keep + [prefix + s for s in STATISTICS],
            )

    return kept.mapInArrow(run, schema)


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above, limit): above is >, else <=


def grow_rules(x: np.ndarray, y: np.ndarray, depth: int, least: int) -> list[Rule]:
    """Rules of one tree: the path of every node below the root.  Splits by Gini gain over quantiles."""
    out: list[Rule] = []

    def split(rows: np.ndarray, path: Rule) -> None:
        if len(path) == depth or len(rows) < 2 * least or y[rows].min() == y[rows].max():
            return
        best = (1e-9, None, None)
        total, ones = len(rows), y[rows].sum()
        base = ones * (total - ones) / total
        for j in range(x.shape[1]):
            v = x[rows, j]
            order = np.argsort(v, kind="stable")
            sv, sy = v[order], np.cumsum(y[rows][order])
            cut = np.flatnonzero(sv[1:] > sv[:-1]) + 1
            cut = cut[(cut >= least) & (cut <= total - least)]
            if len(cut) == 0:
                continue
            left_ones = sy[cut - 1]
            right, right_ones = total - cut, ones - left_ones
            gain = base - left_ones * (cut - left_ones) / cut - right_ones * (right - right_ones) / right
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], j, float((sv[cut[k] - 1] + sv[cut[k]]) / 2))
        if best[1] is None:
            return
        for above in (False, True):
            rule = path + ((best[1], above, best[2]),)
            out.append(rule)
            side = x[rows, best[1]] > best[2]
            split(rows[side == above], rule)

    split(np.arange(len(y)), ())
    return out


def rule_matrix(x: np.ndarray, rules: list[Rule]) -> np.ndarray:
    out = np.ones((len(x), len(rules)), dtype=bool)
    for i, rule in enumerate(rules):
        for j, above, limit in rule:
            out[:, i] &= (x[:, j] > limit) == above
    return out.astype(np.float64)


def lasso_logistic(m: np.ndarray, y: np.ndarray, penalty: float, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and intercept of the L1-penalised logistic fit (accelerated proximal gradient)."""
    n, d = m.shape
    top = np.ones(d)
    for _ in range(20):
        top = m.T @ (m @ top)
        top /= np.linalg.norm(top) + 1e-12
    rate = 1 / (0.25 * (np.linalg.norm(m @ top) ** 2 / n + 1) + 1e-9)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    w, b = np.zeros(d), np.log(share / (1 - share))
    look_w, look_b, t = w.copy(), b, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(look_b + m @ look_w)))
        new_w = look_w - rate * (m.T @ (p - y)) / n
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - rate * penalty, 0)
        new_b = look_b - rate * (p - y).mean()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look_w = new_w + (t - 1) / t_next * (new_w - w)
        look_b = new_b + (t - 1) / t_next * (new_b - b)
        w, b, t = new_w, new_b, t_next
    return w, float(b)


class RuleEnsemble:
    """Weighted rules over the statistics, and the intercept."""

    def __init__(self, rules: list[Rule], weights: list[float], intercept: float):
        self.rules, self.weights, self.intercept = rules, weights, intercept

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.intercept + rule_matrix(x, self.rules) @ np.array(self.weights))))

    def column(self, prefix: str = PREFIX) -> Column:
        """The score as a Spark expression over the columns of ``with_statistics``."""
        z = F.lit(float(self.intercept))
        for rule, weight in zip(self.rules, self.weights):
            test = None
            for j, above, limit in rule:
                value = F.col(f"`{prefix}{STATISTICS[j]}`")
                part = value > F.lit(limit) if above else value <= F.lit(limit)
                test = part if test is None else test & part
            z = z + F.when(test, F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, penalty: float = 2e-3, seed: int = 3) -> RuleEnsemble:
    n = len(y)
    if n == 0 or y.min() == y.max():
        share = y.mean() if n else 0.0
        return RuleEnsemble([], [], float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    rng = np.random.default_rng(seed)
    rules: dict[Rule, None] = {}
    least = max(5, n // 500)
    for _ in range(trees):
        rows = rng.permutation(n)[: max(2, n // 2)]
        some = np.sort(rng.permutation(x.shape[1])[: max(1, 2 * x.shape[1] // 3)])
        for rule in grow_rules(x[np.ix_(rows, some)], y[rows], depth, least):
            rules.setdefault(tuple((int(some[j]), above, limit) for j, above, limit in rule))
    names = list(rules)
    if not names:
        share = y.mean()
        return RuleEnsemble([], [], float(np.log(share / (1 - share))))
    w, b = lasso_logistic(rule_matrix(x, names), y.astype(float), penalty)
    used = np.flatnonzero(np.abs(w) > 1e-6)
    return RuleEnsemble([names[i] for i in used], [float(w[i]) for i in used], b)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 8_000, modulus: int = 4, held_out: int = 2, **options) -> RuleEnsemble:
    """The ensemble for ``labels.quality`` from rows outside the held-out remainder."""
    sample = labelled_sample(docs, labels, "quality", modulus, held_out, max_rows)
    rows = sorted(tuple(r) for r in with_statistics(sample, ["doc_id", "y"]).collect())
    x = np.array([r[2:] for r in rows], float).reshape(len(rows), len(STATISTICS))
    return fit(x, np.array([r[1] for r in rows], float), **options)


def score(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """doc_id, score for every row of ``docs`` (doc_id, text)."""
    return with_statistics(wide_input(docs, "doc_id", "text"), ["doc_id"]).select("doc_id", model.column().alias("score"))


def keep_good(docs: DataFrame, model: RuleEnsemble, limit: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score at least ``limit``, with their columns."""
    prefix = PREFIX
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    kept = with_statistics(docs, docs.columns, prefix).where(model.column(prefix) >= limit)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
