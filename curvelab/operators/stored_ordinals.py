"""F3 over a growing table: counts by (class, key range) are stored, and new files extend them.

``class_ordinal_head`` reads every row's key to place borders and count ranges.  Where
files arrive in loads, that work is done once for each load: ``append_counts`` writes the
load's counts beside those of the earlier loads, over the borders of the first one, and
``split_quota_stored`` splits all rows by the summed counts.  A late key that sorts between
old ones falls into an old range and moves the positions of the ranges after it, without
an old row being counted again.

A range whose rows all lie within the quota is train and one that begins after it is test,
by its counts alone.  Only the one range of a class that the quota ends in is numbered, by
``class_ordinal`` with borders of its own, so its groups are bounded however much the range
has grown since its borders were set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curvelab.operators.ordinal import _RANGE, class_ordinal, range_borders, with_borders
from curvelab.session import materialize
from curvelab.sources.optional import read_if_there


def _stored_borders(spark: SparkSession, path: str) -> str | None:
    stored = read_if_there(lambda: spark.read.parquet(f"{path}/borders"))
    row = stored.first() if stored is not None else None
    return row["borders"] if row else None


def append_counts(rows: DataFrame, path: str, load: str, class_col: str = "class_name",
                  order_cols=("num", "file_name"), buckets: int | None = None) -> None:
    """Count the rows of one load.  The first load places the borders.  A load given again (a
    job that was restarted) replaces its own counts."""
    spark = rows.sparkSession
    borders = _stored_borders(spark, path)
    if borders is None:
        borders, _ = range_borders(rows, order_cols, buckets)
        spark.createDataFrame([(borders,)], "borders string").coalesce(1).write.mode("overwrite").parquet(f"{path}/borders")
    counts = with_borders(rows, order_cols, borders).groupBy(F.col(class_col).alias("_so_class"), F.col(_RANGE).alias("_so_range"))
    counts.agg(F.count(F.lit(1)).alias("_so_n")).write.mode("overwrite").parquet(f"{path}/counts/load={load}")


def _positions(spark: SparkSession, path: str) -> DataFrame:
    """(class, range, first, last): positions of a range's rows in their class, over all loads."""
    counts = spark.read.parquet(f"{path}/counts").groupBy("_so_class", "_so_range").agg(F.sum("_so_n").alias("_so_n"))
    upto = Window.partitionBy("_so_class").orderBy("_so_range").rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("_so_last", F.sum("_so_n").over(upto)).select(
        "_so_class", "_so_range", (F.col("_so_last") - F.col("_so_n")).alias("_so_before"), "_so_last"
    )


def split_quota_stored(rows: DataFrame, path: str, n_train: int, class_col: str = "class_name",
                       order_cols=("num", "file_name"), buckets: int | None = None) -> DataFrame:
    """``split_quota`` of ``rows``, all loads together, by the counts stored at ``path``.

    A row whose class and range were never counted ends the job with an error: its load was
    not appended."""
    spark, n = rows.sparkSession, int(n_train)
    borders = _stored_borders(spark, path)
    if borders is None:
        raise ValueError(f"no counts are stored at {path}")
    positions = materialize(_positions(spark, path), "positions", cluster_by=None)
    ranged = with_borders(rows, order_cols, borders)
    on = F.col(class_col).eqNullSafe(F.col("_so_class")) & (F.col(_RANGE) == F.col("_so_range"))
    scratch = [_RANGE, "_so_class", "_so_range", "_so_before", "_so_last"]
    at_edge = (F.col("_so_before") < n) & (F.col("_so_last") > n)

    placed = ranged.join(positions, on, "left")
    unknown = F.raise_error(F.lit(f"rows of a load that was not counted at {path}"))
    settled = placed.where(~F.coalesce(at_edge, F.lit(False))).withColumn(
        "split", F.when(F.col("_so_last") <= n, "train").when(F.col("_so_before") >= n, "test").otherwise(unknown)
    )
    edge = ranged.join(positions.where(at_edge), on, "inner")
    numbered = class_ordinal(edge.drop(_RANGE, "_so_class", "_so_range"), class_col, list(order_cols), "_so_num", buckets)
    split = F.when(F.col("_so_before") + F.col("_so_num") <= n, "train").otherwise("test")
    numbered = numbered.withColumn("split", split).drop("_so_before", "_so_last", "_so_num")
    return settled.drop(*scratch).unionByName(numbered)
