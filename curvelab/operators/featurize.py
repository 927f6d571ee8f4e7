"""Turn raw objects into fixed-width vectors as a distributed job.

* ``text_features``: hashed, L2-normalised character trigrams of the *whole*
  text (numpy over Arrow batches, or Spark ML transformers in the JVM).
* ``featurize``: any pretrained model through ``model_factory``; the model is
  built once per task and fed Arrow batches (iterator pandas UDF).
* ``skip_if_featurized``: only objects without features yet (left anti join).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed defaults of the text featurizer.
TEXT_DIMS = 256
TEXT_NGRAM = 3


# Fixed values of the Arrow text featurizer: characters dropped before n-grams (line
# terminators, as a regex '.' skips them) and the multiplier of the trigram hash.
LINE_BREAKS = "\n\r\u0085\u2028\u2029"
TRIGRAM_MULT = 0x9E3779B97F4A7C15


def trigram_matrix(texts, dims: int = TEXT_DIMS) -> np.ndarray:
    """Hashed character-trigram counts of each whole text, scaled to unit length: (n, dims).

    The code points of a whole batch lie in one buffer; a trigram key is made at every
    position that has two more characters of the same text behind it, hashed
    multiplicatively, and counted by (text, bucket) in one ``bincount``."""
    clean = [(t or "").lower() for t in texts]
    sizes = np.array([len(t) for t in clean], np.int64)
    points = np.frombuffer("".join(clean).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    row = np.repeat(np.arange(len(clean)), sizes)
    keep = np.ones(len(points), dtype=bool)
    for c in LINE_BREAKS:
        keep &= points != ord(c)
    points, row = points[keep], row[keep]
    out = np.zeros((len(clean), dims))
    if len(points) >= 3:
        inside = row[2:] == row[:-2]
        wide = points.astype(np.uint64)
        key = (wide[:-2] << np.uint64(42)) ^ (wide[1:-1] << np.uint64(21)) ^ wide[2:]
        bucket = ((key * np.uint64(TRIGRAM_MULT)) >> np.uint64(40)).astype(np.int64) % dims
        cells = (row[:-2] * dims + bucket)[inside]
        out = np.bincount(cells, minlength=len(clean) * dims).astype(np.float64).reshape(len(clean), dims)
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.where(norm > 0, norm, 1.0)


def trigram_vectors(texts: pd.Series, dims: int = TEXT_DIMS, batch_chars: int = 4 << 20) -> pd.Series:
    """``trigram_matrix`` over groups of texts of about ``batch_chars`` characters (a longer text is
    a group of its own)."""
    out, group, size = [], [], 0
    for t in texts:
        if group and size + len(t or "") > batch_chars:
            out += list(trigram_matrix(group, dims))
            group, size = [], 0
        group.append(t)
        size += len(t or "")
    if group:
        out += list(trigram_matrix(group, dims))
    return pd.Series(out, dtype=object)


def text_features(df: DataFrame, text_col: str = "text", out_col: str = "features",
                  dims: int = TEXT_DIMS, n: int = TEXT_NGRAM, method: str = "arrow") -> DataFrame:
    """Lower-cased character n-grams of the whole text -> hashed counts -> unit
    length, as array<double>.

    ``method="arrow"`` (default, trigrams): numpy over Arrow batches.
    ``method="jvm"``: Spark ML tokenizer, n-grams, hashing and normaliser.
    Measured on 10,000 documents (24 M characters, local[8], warm): 1.6 s
    against 6.6 s -- the JVM path builds one string object per character and
    per n-gram."""
    src = df
    if method == "arrow":
        if n != 3:
            raise ValueError("the Arrow featurizer builds trigrams; use method='jvm' for other n")

        @F.pandas_udf("array<double>")
        def hashed_trigrams(texts: pd.Series) -> pd.Series:
            return trigram_vectors(texts, dims)

        return src.withColumn(out_col, hashed_trigrams(F.col(text_col)))
    if method != "jvm":
        raise ValueError(f"unknown method {method!r}")
    from pyspark.ml.feature import HashingTF, NGram, Normalizer, RegexTokenizer
    from pyspark.ml.functions import vector_to_array

    chars, grams, tf, unit = "_fz_chars", "_fz_grams", "_fz_tf", "_fz_unit"
    # all four are plain transformers (nothing to fit): JVM-side, row by row
    stages = [
        RegexTokenizer(inputCol=text_col, outputCol=chars, pattern=".", gaps=False, minTokenLength=1,
                       toLowercase=True),
        NGram(n=n, inputCol=chars, outputCol=grams),
        HashingTF(numFeatures=dims, inputCol=grams, outputCol=tf),
        Normalizer(p=2.0, inputCol=tf, outputCol=unit),
    ]
    out = src
    for stage in stages:
        out = stage.transform(out)
    return out.withColumn(out_col, vector_to_array(unit, "float64")).drop(chars, grams, tf, unit)


def featurize(df: DataFrame, model_factory: Callable[[], Callable], input_col: str, out_col: str = "features",
              dims: int | None = None) -> DataFrame:
    """Apply ``model_factory()(batch) -> (n, d) array`` to ``input_col`` in Arrow batches.

    ``model_factory`` is called once per task (not per row); it must be
    picklable (e.g. a module-level function or a ``functools.partial``).
    """

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = model_factory()
        for s in batches:
            out = np.asarray(model(s), dtype=np.float64)
            if dims is not None and out.shape[1] != dims:
                raise ValueError(f"model returned {out.shape[1]} dims, expected {dims}")
            yield pd.Series(list(out))

    return df.withColumn(out_col, run(F.col(input_col)))


def _apart(model: Callable, batch: pd.Series, dims: int | None) -> list[tuple]:
    """(vector, reason) of every input; a batch that raises is halved until the failing inputs are alone."""
    try:
        out = np.asarray(model(batch), dtype=np.float64)
        if out.ndim != 2 or len(out) != len(batch) or (dims is not None and out.shape[1] != dims):
            raise ValueError(f"model returned shape {out.shape} for {len(batch)} inputs")
        return [(v, None) for v in out]
    except Exception as error:  # noqa: BLE001 - whatever a model raises is the input's reason
        if len(batch) == 1:
            return [(None, f"{type(error).__name__}: {error}")]
        half = len(batch) // 2
        return _apart(model, batch.iloc[:half], dims) + _apart(model, batch.iloc[half:], dims)


def featurize_apart(df: DataFrame, model_factory: Callable[[], Callable], input_col: str, out_col: str = "features",
                    reason_col: str = "reason", dims: int | None = None) -> DataFrame:
    """``featurize`` that no input can end: one whose model raises, or gives no vector of ``dims``
    components, has a null vector and the reason; the others of its batch keep theirs.  A batch with
    k failing inputs of n costs about 2 k log n calls."""

    @F.pandas_udf("struct<vector: array<double>, reason: string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = model_factory()
        for s in batches:
            found = _apart(model, s, dims) if len(s) else []
            yield pd.DataFrame({"vector": pd.Series([v for v, _ in found], dtype=object), "reason": pd.Series([r for _, r in found], dtype=object)})

    both = "_fz_found"
    return (
        df.withColumn(both, run(F.col(input_col)))
        .withColumn(out_col, F.col(both)["vector"])
        .withColumn(reason_col, F.col(both)["reason"])
        .drop(both)
    )


def skip_if_featurized(inputs: DataFrame, features: DataFrame, key: str = "path") -> DataFrame:
    """Inputs whose key has no feature row yet."""
    return inputs.join(features.select(key), key, "left_anti")
