"""The bucketed per-class ordinal equals row_number() and copes with a hot class."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from curvelab.operators.ordinal import class_ordinal
from tests.conftest import SF_MID


def _check(df, cls, key):
    got = class_ordinal(df, cls, key, out_col="num", buckets=7)
    want = df.withColumn("want", F.row_number().over(Window.partitionBy(cls).orderBy(key)))
    j = got.join(want.select(key, "want"), key)
    assert got.count() == df.count()
    assert j.filter(F.col("num") != F.col("want")).count() == 0


def test_matches_row_number(spark):
    emb = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    _check(emb, "label", "vec_id")


def test_hot_class_and_nulls(spark):
    # one class holds most rows; a null class is numbered like row_number does
    rows = [(i, "hot" if i % 3 else ("cold" if i % 2 else None)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, c string")
    _check(df, "c", "k")


def _check_head(df, cls, key, n):
    from curvelab.operators.ordinal import class_ordinal_head

    got = class_ordinal_head(df, cls, key, n, out_col="num")
    want = df.withColumn("want", F.row_number().over(Window.partitionBy(cls).orderBy(key)))
    want = want.withColumn("want", F.when(F.col("want") <= n, F.col("want")).otherwise(n + 1))
    j = got.join(want.select(key, "want"), key)
    assert got.count() == df.count()  # every row kept, none multiplied
    assert j.filter(F.col("num") != F.col("want")).count() == 0


def test_head_matches_row_number_up_to_n(spark):
    emb = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    _check_head(emb, "label", "vec_id", 20)


def test_head_hot_class_and_nulls(spark):
    rows = [(i, "hot" if i % 3 else ("cold" if i % 2 else None)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, c string").repartition(12)
    for n in (50, 1001, 1500, 5000):  # also beyond Spark's own limit for ranking windows
        _check_head(df, "c", "k", n)


def test_head_on_text_keys(spark):
    rows = [(f"file_{i % 700:05d}_{i}", "a" if i % 5 else "b") for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, c string").repartition(5)
    _check_head(df, "c", "k", 1200)


def test_head_tied_keys_are_numbered_apart(spark):
    from curvelab.operators.ordinal import class_ordinal_head

    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (3, "a"), (None, "b"), (None, "b")], "k long, c string")
    got = class_ordinal_head(df, "c", "k", 2, out_col="num").collect()
    assert sorted(r["num"] for r in got if r["c"] == "a") == [1, 2, 3, 3]
    assert sorted(r["num"] for r in got if r["c"] == "b") == [1, 2]


def test_late_ranges_are_not_shuffled(spark):
    """Rows beyond the first n of their class are settled without an exchange of their own columns."""
    from curvelab.operators.ordinal import class_ordinal_head

    emb = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    out = class_ordinal_head(emb, "label", "vec_id", 5, buckets=50)
    head = out.where("num <= 5")
    assert head.count() == 50 and out.count() == emb.count()
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") <= 2  # one over the offsets table, one over the early ranges


def test_ordinals_are_bigint_and_offsets_may_be_large(spark, monkeypatch):
    from pyspark.sql import functions as F

    from curvelab.operators import ordinal

    df = spark.createDataFrame([(1, "a"), (2, "a")], "k long, c string")
    real = ordinal._offsets
    monkeypatch.setattr(ordinal, "_offsets", lambda r, c: real(r, c).withColumn("_ord_off", F.col("_ord_off") + 3_000_000_000))
    got = class_ordinal(df, "c", "k", buckets=2)
    assert dict(got.dtypes)["num"] == "bigint"
    assert min(r["num"] for r in got.collect()) == 3_000_000_001


def _largest_group(ranged, cls="c"):
    from curvelab.operators.ordinal import _RANGE

    return ranged.groupBy(cls, _RANGE).count().agg(F.max("count")).first()[0]


def test_ranges_are_bounded_with_a_hot_class_and_a_hot_text_key(spark):
    """A third of the rows in one class, a tenth under one key, more ranges than 256."""
    from curvelab.operators.ordinal import class_ordinal_head, with_ranges

    n, p = 30_000, 400
    df = spark.range(n, numPartitions=6).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 40)).alias("c"),
        F.when(F.col("id") % 10 == 0, "same.jpg").otherwise(F.format_string("f_%06d.jpg", F.col("id") * 7919 % n)).alias("k"),
    )
    ranged, order = with_ranges(df, ["k"], p)
    assert len(order) == 2 and _largest_group(ranged) <= 4 * n / p
    assert ranged.select("_ord_range").distinct().count() > 256
    got = class_ordinal(df, "c", "k", buckets=p)
    want = df.withColumn("first", F.rank().over(Window.partitionBy("c").orderBy("k"))).withColumn(
        "last", F.col("first") + F.count("id").over(Window.partitionBy("c", "k")) - 1)
    wrong = got.join(want.select("id", "first", "last"), "id").where(~F.col("num").between(F.col("first"), F.col("last")))
    assert got.columns == ["id", "c", "k", "num"] and got.count() == n and wrong.count() == 0
    assert got.select("c", "num").distinct().count() == n
    head = class_ordinal_head(df, "c", "k", 500, buckets=p)
    assert head.columns == got.columns and head.count() == n
    assert head.where("c = 'hot' AND num <= 500").count() == 500


def test_ranges_of_equal_and_null_numbers_are_split(spark):
    from curvelab.operators.ordinal import with_ranges

    df = spark.range(20_000).select("id", F.lit("a").alias("c"), F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 3 == 1, F.col("id")).alias("k"))
    ranged, _ = with_ranges(df, ["k"], 100)
    assert _largest_group(ranged) <= 4 * 20_000 / 100
    nums = [r["num"] for r in class_ordinal(df, "c", "k", buckets=100).orderBy("num").select("num").collect()]
    assert nums == list(range(1, 20_001))


def test_other_key_types_and_empty_input(spark):
    rows = spark.range(300).select(
        "id", F.lit("a").alias("c"),
        F.timestamp_micros(F.col("id") * 1_000_003).alias("t"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("d"),
        F.when(F.col("id") == 7, float("nan")).otherwise(-F.col("id") / 3).alias("x"), F.encode(F.format_string("%04d", "id"), "utf-8").alias("b"),
        F.create_map(F.lit("m"), F.col("id")).alias("m"), (F.col("id") / 7).cast("decimal(20,6)").alias("e"),
    )
    for key in ("t", "d", "x", "b", "e"):
        want = rows.withColumn("want", F.row_number().over(Window.partitionBy("c").orderBy(key))).select("id", "want")
        assert class_ordinal(rows, "c", key, buckets=9).join(want, "id").where("num != want").count() == 0, key
    assert class_ordinal(rows.where("id < 0"), "c", "id").count() == 0


def test_dense_index(spark):
    from curvelab.operators.ordinal import dense_index

    names = [f"c{i:04d}" for i in range(500)]
    df = spark.createDataFrame([(n,) for n in names * 2] + [(None,)], "c string").repartition(7)
    got = {r["c"]: r["label_idx"] for r in dense_index(df, "c").collect()}
    assert got == {n: i for i, n in enumerate(names)}


def test_bounded_broadcast_hints_only_under_the_bound(spark):
    from curvelab.session import bounded_broadcast

    df = spark.range(10).withColumnRenamed("id", "k")

    def hinted(side):
        return "strategy=broadcast" in side._jdf.queryExecution().analyzed().toString()

    small = bounded_broadcast(df, "t_small", 1000)
    big = bounded_broadcast(df, "t_big", 50)
    assert hinted(small) and not hinted(big)
    wide = spark.range(10).selectExpr("repeat('x', 1000) AS k")
    assert not hinted(bounded_broadcast(wide, "t_wide", 1000))
    assert sorted(r["k"] for r in small.collect()) == list(range(10))


def test_quota_over_appended_loads_equals_the_quota_over_their_union(spark, tmp_path):
    from curvelab.operators.splits import split_quota
    from curvelab.operators.stored_ordinals import append_counts, split_quota_stored

    df = spark.range(4000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 101 != 0, F.concat(F.lit("c"), F.col("id") % 7)).alias("class_name"),
        (F.col("id") * 37 % 4000).alias("num"), F.format_string("f%05d", F.col("id")).alias("file_name"))
    # later loads hold keys between old ones, and a class that is new
    loads = [df.where("num % 2 = 0 AND class_name != 'c5' AND num < 1000"), df.where("num % 2 = 1 AND class_name != 'c5'"),
             df.where("NOT coalesce(num % 2 = 0 AND class_name != 'c5' AND num < 1000, false) AND NOT coalesce(num % 2 = 1 AND class_name != 'c5', false)")]
    path = str(tmp_path / "ordinals")
    for i, load in enumerate(loads):
        append_counts(load, path, f"l{i}", buckets=16)
    append_counts(loads[1], path, "l1", buckets=16)  # a restarted job counts its load once
    for quota in (1, 60, 500, 5000):
        got = split_quota_stored(df, path, quota, buckets=8)
        want = split_quota(df, quota).select("id", F.col("split").alias("want"))
        assert got.columns == [*df.columns, "split"] and got.count() == 4000
        assert got.join(want, "id").where("split != want").count() == 0


def test_rows_that_were_not_counted_are_refused(spark, tmp_path):
    import pytest
    from pyspark.errors import PySparkException

    from curvelab.operators.stored_ordinals import append_counts, split_quota_stored

    df = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "class_name string, num long, file_name string")
    append_counts(df.where("class_name = 'a'"), str(tmp_path / "o"), "first")
    with pytest.raises(PySparkException, match="not counted"):
        split_quota_stored(df, str(tmp_path / "o"), 1).collect()
    with pytest.raises(ValueError, match="no counts"):
        split_quota_stored(df, str(tmp_path / "none"), 1)
