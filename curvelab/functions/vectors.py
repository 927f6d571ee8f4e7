"""P4/P9 and vector arithmetic as built-in higher-order expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double_array(c) -> Column:
    return _col(c).cast("array<double>")


def parse_vector(parts, start: int = 1) -> Column:
    """array<string> -> array<double> from 1-based position ``start``, trimming blanks."""
    p = _col(parts)
    tail = F.slice(p, start, F.greatest(F.size(p) - start + 1, F.lit(0)))
    return F.transform(tail, lambda x: F.trim(x).cast("double"))


def quantize(features, scale: float = 1e6) -> Column:
    """Scale and round a vector to integers so text forms are engine independent."""
    return F.transform(_col(features), lambda x: F.round(x * F.lit(scale)).cast("bigint"))


def encode_feature_line(class_col, num_col, features) -> Column:
    """``class,num,f1, f2, ...`` (blank after the feature commas)."""
    feats = F.array_join(F.transform(_col(features), lambda x: x.cast("string")), ", ")
    return F.concat_ws(",", _col(class_col).cast("string"), _col(num_col).cast("string"), feats)


def encode_labeled_line(label_col, features) -> Column:
    """``label,f1,f2,...``."""
    feats = F.array_join(F.transform(_col(features), lambda x: x.cast("string")), ",")
    return F.concat_ws(",", _col(label_col).cast("string"), feats)


def encode_feature_json(features) -> Column:
    """JSON array text with ``, `` separators."""
    feats = F.array_join(F.transform(_col(features), lambda x: x.cast("string")), ", ")
    return F.concat(F.lit("["), feats, F.lit("]"))


def dot(a, b) -> Column:
    """Sum of element-wise products, evaluated in the JVM."""
    prods = F.zip_with(_col(a), _col(b), lambda x, y: x * y)
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, v: acc + v)
