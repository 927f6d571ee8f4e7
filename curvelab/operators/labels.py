"""Dense class index and its decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelab.operators.ordinal import dense_index
from curvelab.session import bounded_broadcast, materialize
from curvelab.sources.optional import read_if_there


def label_map(df: DataFrame, class_col: str = "class_name") -> DataFrame:
    """P7 map: ``label_idx`` 0..k-1 by class name (deterministic), over the *distinct classes* only."""
    return dense_index(df, class_col, "label_idx").select("label_idx", F.col(class_col).alias("class_name"))


def extended_label_map(stored: DataFrame | None, df: DataFrame, class_col: str = "class_name") -> DataFrame:
    """P7 map that keeps the indexes of ``stored`` (label_idx, class_name) and gives the classes it lacks
    the next ones, in name order.  A class that ``df`` lacks keeps its index."""
    if stored is None:
        return label_map(df, class_col)
    stored = stored.select("label_idx", "class_name")
    names = df.select(F.col(class_col).alias("class_name")).where(F.col("class_name").isNotNull()).distinct()
    new = label_map(names.join(stored, "class_name", "left_anti"))
    start = (stored.agg(F.max("label_idx")).first()[0] or 0) + 1 if not stored.isEmpty() else 0
    return stored.unionByName(new.withColumn("label_idx", (F.col("label_idx") + F.lit(start)).cast("int")))


def update_label_map(df: DataFrame, path: str, class_col: str = "class_name") -> DataFrame:
    """The stored dictionary at ``path`` with the classes of ``df`` appended, so that labels written
    earlier keep their meaning; the whole map is returned."""
    spark = df.sparkSession
    stored = read_if_there(lambda: spark.read.parquet(path))
    whole = materialize(extended_label_map(stored, df, class_col), "label_map", cluster_by=None)
    new = whole if stored is None else whole.join(stored.select("class_name"), "class_name", "left_anti")
    new.select("label_idx", "class_name").write.mode("append").parquet(path)
    return whole


def label_index(df: DataFrame, class_col: str = "class_name", mapping: DataFrame | None = None) -> DataFrame:
    """Add ``label_idx`` (double ``label`` too, as the labelled-line format wants)."""
    m = mapping if mapping is not None else label_map(df, class_col)
    # the map has one row per class: written, its bytes counted, broadcast when bounded
    m = bounded_broadcast(m.withColumnRenamed("class_name", "_lm_class"), "label_map")
    joined = df.join(m, F.col(class_col) == F.col("_lm_class"), "left")
    return joined.drop("_lm_class").withColumn("label", F.col("label_idx").cast("double"))


def label_decode(df: DataFrame, mapping: DataFrame, idx_col: str = "prediction", out_col: str = "predicted_class") -> DataFrame:
    """Index -> class name."""
    m = mapping.select(F.col("label_idx").alias("_ld_idx"), F.col("class_name").alias(out_col))
    m = bounded_broadcast(m, "label_map")
    return df.join(m, F.col(idx_col).cast("int") == F.col("_ld_idx"), "left").drop("_ld_idx")
