"""Binary relabelling.  The named class is label 0.0, the other(s) 1.0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_1v1(class_col, class_a: str) -> Column:
    """P5: class_a -> 0.0, the other class -> 1.0 (rows already filtered to {a, b})."""
    c = F.col(class_col) if isinstance(class_col, str) else class_col
    return F.when(c == F.lit(class_a), F.lit(0.0)).otherwise(F.lit(1.0))


def label_1vall(class_col, target: str) -> Column:
    """Target -> 0.0, every other class -> 1.0."""
    c = F.col(class_col) if isinstance(class_col, str) else class_col
    return F.when(c == F.lit(target), F.lit(0.0)).otherwise(F.lit(1.0))
