"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvelab.session import materialize, table_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read again.

    Later steps read files that outlive executors, so nothing above is computed
    twice or lost with one of them."""
    return materialize(df, name, cluster_by=None)


def wide_input(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns; the operators never see clashing extra ones."""
    return df.select(*[F.col(c) for c in columns])


def in_remainder(key: str, modulus: int, remainder: int):
    """True where crc32 of the key as text leaves ``remainder``; a null key counts as remainder 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(0)) % modulus == remainder
