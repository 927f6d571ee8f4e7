"""Counts, error rate and success percentage.

Rates are derived from integer counts with exact half-up rounding done in
integer arithmetic, so every engine prints the same value:
``success_pct = round_half_up(100 * (n - wrong) / n, 2)``; ``n = 0`` or an unknown
``wrong`` -> null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio_half_up(num, den, decimals: int, scale: int = 1) -> Column:
    """``round_half_up(scale * num / den, decimals)`` using integer arithmetic; null when den = 0."""
    unit = scale * 10 ** decimals
    # 38-digit integers: exact for any bigint count
    n = _c(num).cast("decimal(38,0)")
    d = _c(den).cast("decimal(38,0)")
    doubled = F.lit(2 * unit).cast("decimal(10,0)") * n.cast("decimal(20,0)") + d.cast("decimal(20,0)")
    whole = F.call_function("div", doubled, F.lit(2).cast("decimal(1,0)") * d.cast("decimal(20,0)"))
    return F.when(_c(den) > 0, whole / F.lit(float(10 ** decimals)))


def success_pct(n_rows, n_wrong) -> Column:
    """A3: success percentage, 2 decimals."""
    return ratio_half_up(_c(n_rows) - _c(n_wrong), n_rows, 2, scale=100)


def error_rate(n_rows, n_wrong) -> Column:
    """A2: wrong / rows, 6 decimals."""
    return ratio_half_up(n_wrong, n_rows, 6)


def majority_pct(n_rows, n_pos) -> Column:
    """Success of always predicting the more frequent label."""
    return ratio_half_up(F.greatest(_c(n_pos), _c(n_rows) - _c(n_pos)), n_rows, 2, scale=100)


def count_rows(df: DataFrame) -> DataFrame:
    """A1."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def error_counts(df: DataFrame, label: str = "label", prediction: str = "prediction", by=()) -> DataFrame:
    """A2 in one pass: rows, wrong and rate (optionally per group).  A row without a
    prediction is wrong."""
    wrong = F.sum((~F.col(label).eqNullSafe(F.col(prediction))).cast("bigint"))
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(wrong, F.lit(0)).alias("n_wrong")).withColumn(
        "error_rate", error_rate("n_rows", "n_wrong")
    ).withColumn("success_pct", success_pct("n_rows", "n_wrong"))


def class_counts(df: DataFrame, class_col: str = "class_name") -> DataFrame:
    """A5: rows per class (partial aggregation, no row lists)."""
    return df.groupBy(class_col).agg(F.count(F.lit(1)).alias("n_rows"))


def curve_table(curve: DataFrame) -> DataFrame:
    """The curve as ordered (x = size, y = success_pct) points per task."""
    return curve.select(
        "task_type", "class_a", "class_b", "size", "success_pct"
    ).orderBy("task_type", "class_a", "class_b", "size")
