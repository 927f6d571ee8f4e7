"""Name parsing and vector text forms, including the edge cases."""

from pyspark.sql import functions as F

from curvelab.functions import (
    base_name,
    class_and_num,
    class_from_first_digit,
    encode_feature_json,
    encode_feature_line,
    encode_labeled_line,
    parse_vector,
)


def _one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("o")).first()["o"]


def test_base_name(spark):
    assert _one(spark, base_name, "s3://bucket/a/b/border_collie_12.jpg") == "border_collie_12.jpg"
    assert _one(spark, base_name, "plain.jpg") == "plain.jpg"


def test_class_from_first_digit(spark):
    f = class_from_first_digit
    assert _one(spark, f, "border_collie_102.jpg.json") == "border_collie"
    assert _one(spark, f, "great_pyrenees_3.jpg.json") == "great_pyrenees"
    assert _one(spark, f, "12_cat.jpg.json") is None        # first digit at position 0
    assert _one(spark, f, "cat.jpg.json") is None           # no digit at all
    assert _one(spark, f, "a1.json") is None                # empty class


def test_class_and_num(spark):
    def both(v):
        r = spark.createDataFrame([(v,)], "v string").select(class_and_num("v").alias("o")).first()["o"]
        return (r["class_name"], r["num"])

    assert both("border_collie_102.jpg") == ("border_collie", 102)
    assert both("american_pit_bull_terrier_7.jpg") == ("american_pit_bull_terrier", 7)
    assert both("beagle12.jpg") == (None, None)              # no underscore before the number
    assert both("beagle_12.png") == (None, None)             # wrong suffix
    assert both("beagle_x.jpg") == (None, None)              # not a number
    assert both("beagle_99999999999.jpg") == ("beagle", 99999999999)
    assert both("beagle_99999999999999999999.jpg") == ("beagle", None)  # number overflows bigint


def test_parse_vector_trims(spark):
    df = spark.createDataFrame([("cls,3,1.5, -2, 3e-1",)], "v string")
    got = df.select(parse_vector(F.split("v", ","), 3).alias("f")).first()["f"]
    assert got == [1.5, -2.0, 0.3]


def test_encoders(spark):
    df = spark.createDataFrame([("beagle", 4, 1.0, [1, -2, 3])], "c string, n int, l double, f array<bigint>")
    r = df.select(
        encode_feature_line("c", "n", "f").alias("line"),
        encode_labeled_line("l", "f").alias("lab"),
        encode_feature_json("f").alias("js"),
    ).first()
    assert r["line"] == "beagle,4,1, -2, 3"
    assert r["lab"] == "1.0,1,-2,3"
    assert r["js"] == "[1, -2, 3]"
