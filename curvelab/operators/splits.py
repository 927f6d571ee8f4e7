"""Row selection for train / test sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelab.operators.ordinal import class_ordinal_head


def filter_two_classes(df: DataFrame, class_a: str, class_b: str, class_col: str = "class_name") -> DataFrame:
    """F1."""
    return df.filter(F.col(class_col).isin(class_a, class_b))


def split_threshold(df: DataFrame, size: int, num_col: str = "num") -> DataFrame:
    """one pass, ``split = 'train'`` when ``num <= size`` else ``'test'``."""
    return df.withColumn("split", F.when(F.col(num_col) <= F.lit(int(size)), "train").otherwise("test"))


def split_quota(df: DataFrame, n_train: int, class_col: str = "class_name", order_cols=("num", "file_name"),
                buckets: int | None = None) -> DataFrame:
    """the first ``n_train`` rows of each class (by ``order_cols``) train, the rest test.

    Rows are ranked in place (``class_ordinal_head``), so names that repeat neither multiply
    rows nor exceed the quota; only the key ranges that hold a class's first ``n_train``
    rows are shuffled, whatever ``n_train`` is."""
    n = int(n_train)
    ranked = class_ordinal_head(df, class_col, list(order_cols), n, out_col="_quota_rank", buckets=buckets)
    return ranked.withColumn("split", F.when(F.col("_quota_rank") <= n, "train").otherwise("test")).drop("_quota_rank")


def misclassified(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """F5."""
    return df.filter(F.col(label) != F.col(prediction))


def sweep_rows(df: DataFrame, sizes, num_col: str = "num") -> DataFrame:
    """The training rows of every requested size in one scan.

    ``rows JOIN broadcast(sizes) ON num <= size``: the size list is a literal
    of the request, so this is a broadcast nested-loop join, and only rows
    with ``num <= max(size)`` are copied (once per size they train for).
    """
    spark = df.sparkSession
    uniq = [int(s) for s in dict.fromkeys(sizes)]
    size_df = spark.createDataFrame([(s,) for s in uniq], "size int")
    train = df.filter(F.col(num_col) <= F.lit(max(uniq)))
    return train.join(F.broadcast(size_df), F.col(num_col) <= size_df["size"])


def sweep_counts(df: DataFrame, sizes, class_col: str = "class_name", num_col: str = "num") -> DataFrame:
    """Rows per (size, class, split) without copying test rows: train counts come
    from ``sweep_rows``; test = class total - train (class totals are one partial
    aggregate)."""
    uniq = [int(s) for s in dict.fromkeys(sizes)]
    totals = df.groupBy(class_col).agg(F.count(F.lit(1)).alias("_total"))
    train = sweep_rows(df.select(class_col, num_col), uniq, num_col).groupBy("size", class_col).agg(
        F.count(F.lit(1)).alias("_train")
    )
    # one row per (class, size): the class totals carry the literal size list
    grid = totals.withColumn("size", F.explode(F.array(*[F.lit(s) for s in uniq]))).join(
        train, ["size", class_col], "left"
    )
    n_train = F.coalesce(F.col("_train"), F.lit(0)).cast("bigint")
    return grid.select(
        "size", class_col,
        F.explode(F.array(
            F.struct(F.lit("train").alias("split"), n_train.alias("n_rows")),
            F.struct(F.lit("test").alias("split"), (F.col("_total") - n_train).alias("n_rows")),
        )).alias("_s"),
    ).select("size", class_col, "_s.split", "_s.n_rows")
