"""S1-S7.  Each reader has a ``parse_*`` half that works on any string column, so
the same expressions serve files, tables and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvelab.functions.names import base_name, class_and_num, class_from_first_digit
from curvelab.functions.vectors import parse_vector

FEATURE_LINE_SCHEMA = "class_name string, num bigint, features array<double>"


def parse_feature_lines(df: DataFrame, col: str = "value") -> DataFrame:
    """S1 parse: ``class,num,f1, f2, ...`` -> class_name, num, features."""
    parts = F.split(F.col(col), ",")
    return df.select(
        F.trim(parts.getItem(0)).alias("class_name"),
        F.trim(parts.getItem(1)).try_cast("bigint").alias("num"),
        parse_vector(parts, 3).alias("features"),
        *[c for c in df.columns if c != col],
    )


def read_feature_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """A folder of feature text files; splits follow the file sizes."""
    r = spark.read
    if glob:
        r = r.option("pathGlobFilter", glob)
    return parse_feature_lines(r.text(path))


def parse_labeled_lines(df: DataFrame, col: str = "value") -> DataFrame:
    """S2 parse: ``label,f1,f2,...`` -> label double, features."""
    parts = F.split(F.col(col), ",")
    return df.select(
        F.trim(parts.getItem(0)).try_cast("double").alias("label"),
        parse_vector(parts, 2).alias("features"),
        *[c for c in df.columns if c != col],
    )


def read_labeled_lines(spark: SparkSession, path: str) -> DataFrame:
    """S2."""
    return parse_labeled_lines(spark.read.text(path))


def parse_feature_json(df: DataFrame, col: str = "value", name_col: str = "file_name") -> DataFrame:
    """S3 parse: JSON array text -> features; class and number from the file name
    (``<class>_<num>.jpg.json``; ``class_first_digit`` is the quota-split rule)."""
    stem = F.regexp_replace(F.col(name_col), r"[.]json$", "")
    cn = class_and_num(stem)
    return df.select(
        F.col(name_col).alias("file_name"),
        cn.getField("class_name").alias("class_name"),
        cn.getField("num").alias("num"),
        class_from_first_digit(F.col(name_col)).alias("class_first_digit"),
        F.from_json(F.col(col), "array<double>").alias("features"),
        *[c for c in df.columns if c not in (col, name_col)],
    )


def read_feature_json(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """S3: one JSON float array per file, the file name identifies the row."""
    raw = (
        spark.read.option("wholetext", True).option("pathGlobFilter", glob).text(path)
        .select("value", F.col("_metadata.file_name").alias("file_name"))
    )
    return parse_feature_json(raw)


def read_images(spark: SparkSession, path: str, glob: str = "*.jpg", recursive: bool = True) -> DataFrame:
    """Image bytes with path, class and number (binaryFile source)."""
    df = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower()).load(path)
    )
    cn = class_and_num(base_name("path"))
    return df.select("path", "modificationTime", "length", "content",
                     cn.getField("class_name").alias("class_name"), cn.getField("num").alias("num"))


def list_inputs(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """Listing only -- ``content`` is never selected, so file bodies are not read.  Spark's
    file sources list no empty files, so those do not appear."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(path)
    return df.select("path", "length", base_name("path").alias("file_name"))


def parse_label_map(df: DataFrame, col: str = "value") -> DataFrame:
    """S6 parse: ``{"0": "class", ...}`` -> label_idx int, class_name."""
    m = F.from_json(F.col(col), "map<string,string>")
    return df.select(F.explode(m).alias("k", "class_name")).select(
        F.col("k").try_cast("int").alias("label_idx"), "class_name"
    )


def read_label_map(spark: SparkSession, path: str) -> DataFrame:
    """S6."""
    return parse_label_map(spark.read.option("wholetext", True).text(path))


def load_mllib_model(spark: SparkSession, path: str) -> DataFrame:
    """S7 for MLlib-format SVM folders: ``data/`` Parquet (weights vector, intercept,
    threshold) read as a DataFrame -> weights array<double>, intercept, threshold."""
    from pyspark.ml.functions import vector_to_array

    data = spark.read.parquet(f"{path.rstrip('/')}/data")
    return data.select(vector_to_array("weights", "float64").alias("weights"), "intercept", "threshold")
