"""Request validation done once at the top of every job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvelab.operators.svm import TASK_1V1, TASK_1VALL

class RequestError(ValueError):
    pass


def parse_sizes(sizes) -> list[int]:
    """Sizes as ints > 0, keeping the caller's order (comma text or iterable)."""
    if isinstance(sizes, str):
        items = [x.strip() for x in sizes.split(",")]
    else:
        items = list(sizes)
    out = []
    for x in items:
        try:
            v = int(x)
        except (TypeError, ValueError):
            raise RequestError(f"training size {x!r} must be a number") from None
        if v <= 0:
            raise RequestError(f"training size ({v}) must be greater than zero")
        out.append(v)
    if not out:
        raise RequestError("at least one training size is required")
    return out


def parse_pair(classes) -> tuple[str, str]:
    """Two distinct class names, from ``"a,b"`` or a sequence."""
    parts = [p.strip() for p in classes.split(",")] if isinstance(classes, str) else [str(p).strip() for p in classes]
    if len(parts) != 2 or not parts[0] or not parts[1]:
        raise RequestError(f"1 vs 1 needs exactly two classes separated by a comma, got {classes!r}")
    if parts[0] == parts[1]:
        raise RequestError("1 vs 1 needs two different classes")
    return parts[0], parts[1]


def validate_request(one_vs_one=None, one_vs_all=None, train=False, test=False, check=False) -> str:
    """The reference's mutual exclusions: 1v1 xor 1vAll; train, test and check exclusive."""
    if (one_vs_one is None) == (one_vs_all is None):
        raise RequestError("either a 1 vs 1 pair or a 1 vs all request is required, not both")
    if sum(bool(x) for x in (train, test, check)) > 1:
        raise RequestError("train, test and check are exclusive")
    return TASK_1V1 if one_vs_one is not None else TASK_1VALL


def request_verdict(one_vs_one, one_vs_all, sizes, train, test, check) -> Column:
    """M13 for a table of requests: why a request is refused, or null.

    Columns or column names: the pair as ``a,b``, the target, the sizes as comma text,
    and three flags.  The rules are those of ``validate_request``, ``parse_pair`` and ``parse_sizes``,
    in that order."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    pair, target, text = col(one_vs_one), col(one_vs_all), col(sizes)
    flags = sum((F.coalesce(col(c), F.lit(False)).cast("int") for c in (train, test, check)), F.lit(0))
    names = F.transform(F.split(pair, ","), lambda x: F.trim(x))
    numbers = F.transform(F.split(text, ","), lambda x: F.trim(x).try_cast("bigint"))
    return (
        F.when(pair.isNull() == target.isNull(), "either a pair or a target")
        .when(flags > 1, "train, test and check are exclusive")
        .when((F.size(names) != 2) | F.exists(names, lambda x: x == ""), "a pair needs two classes")
        .when(F.element_at(names, 1) == F.try_element_at(names, F.lit(2)), "a pair needs two different classes")
        .when(text.isNull() | F.exists(numbers, lambda x: x.isNull()), "sizes must be numbers")
        .when(F.exists(numbers, lambda x: x <= 0), "sizes must be greater than zero")
    )


def known_classes(rows: DataFrame, class_col: str = "class_name") -> DataFrame:
    """Distinct classes with their row counts, as a table."""
    return rows.where(F.col(class_col).isNotNull()).groupBy(class_col).agg(F.count(F.lit(1)).alias("n_rows"))


def class_check(rows: DataFrame, classes, class_col: str = "class_name") -> DataFrame:
    """rows per named class (a filter and one small aggregate; no class list is collected)."""
    return known_classes(rows.where(F.col(class_col).isin(list(classes))), class_col)


def check_classes(rows: DataFrame, classes, class_col: str = "class_name") -> dict[str, int]:
    """every named class must exist; raise otherwise.  Returns the named classes' row counts."""
    known = {r[class_col]: int(r["n_rows"]) for r in class_check(rows, classes, class_col).collect()}
    missing = [c for c in classes if c not in known]
    if missing:
        raise RequestError(f"no rows for class(es): {', '.join(missing)}")
    return known


def rejected_rows(rows: DataFrame, dims: int) -> DataFrame:
    """The rows that no model trains on or scores, with the reason: no class, no number
    (a file name or line of the wrong form), or a vector that is missing, of another length than
    ``dims`` or with nulls."""
    f = F.col("features")
    reason = (
        F.when(F.col("class_name").isNull(), "no class")
        .when(F.col("num").isNull(), "no number")
        .when(f.isNull(), "no vector")
        .when(F.size(f) != dims, "vector length")
        .when(F.exists(f, lambda x: x.isNull()), "null in vector")
    )
    return rows.withColumn("reason", reason).where(F.col("reason").isNotNull())
