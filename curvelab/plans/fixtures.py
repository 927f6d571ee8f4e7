"""Derived inputs built from the given tables (same definition as the oracle SQL).

* ``class_rows``: ``embeddings`` with ``num`` = position of the row inside its
  label ordered by ``vec_id`` and ``class_name = 'breed_' || letter``
  (label 0..9 -> a..j; letters because the first-digit rule needs names
  without digits).
* ``plain_rows``: the same rows without ``num``.
* ``curve_rows``: the same rows for learning curves with sizes up to ``upto``:
  ``num`` exact for the first ``upto`` rows of each label, ``upto + 1`` after
  (every comparison with a size <= ``upto`` is unchanged; no row is dropped).
* ``files``: ``images/<class>_<num>.jpg`` paths for those rows.
* ``lines``: ``class,num,q1, q2, ...`` text with integer ``q = round(x * 1e6)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvelab.functions.vectors import encode_feature_line, quantize
from curvelab.operators.ordinal import class_ordinal, class_ordinal_head
from curvelab.session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def class_name_of(label_col) -> F.Column:
    return F.concat(F.lit("breed_"), F.chr(F.lit(97) + F.col(label_col)))


def _named(numbered: DataFrame) -> DataFrame:
    return numbered.select(
        "vec_id",
        "label",
        class_name_of("label").alias("class_name"),
        "num",
        # kept as array<float>: half the bytes through shuffles and Arrow; the
        # trainers widen to float64 inside the task (exact)
        F.col("embedding").alias("features"),
    )


def plain_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows without ``num``, for queries that need no ordinal: one scan, no shuffle."""
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", "label", class_name_of("label").alias("class_name"), F.col("embedding").alias("features"))


def class_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings")
    return _named(class_ordinal(emb, "label", "vec_id", out_col="num"))


def curve_rows(spark: SparkSession, sf_dir: str, upto: int) -> DataFrame:
    """Rows for curves with sizes <= ``upto``: only the vectors of the key ranges that hold
    a label's first ``upto`` rows are shuffled."""
    emb = read_table(spark, sf_dir, "embeddings")
    return _named(class_ordinal_head(emb, "label", "vec_id", upto, out_col="num"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = class_rows(spark, sf_dir)
    return rows.select(
        "vec_id",
        F.concat(F.lit("images/"), F.col("class_name"), F.lit("_"), F.col("num").cast("string"), F.lit(".jpg")).alias(
            "path"
        ),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = class_rows(spark, sf_dir)
    return rows.select(
        "vec_id", encode_feature_line("class_name", "num", quantize("features")).alias("line")
    )
