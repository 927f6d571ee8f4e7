"""F1-F3, F5, J2, A5 against brute force."""

from collections import Counter

from pyspark.sql import functions as F

from curvelab.operators import metrics, splits

SIZES = [3, 5, 10, 60]


def test_filter_and_threshold(rows):
    two = splits.filter_two_classes(rows, "breed_a", "breed_b")
    assert set(r[0] for r in two.select("class_name").distinct().collect()) == {"breed_a", "breed_b"}
    s = splits.split_threshold(rows, 10)
    bad = s.filter(((F.col("num") <= 10) & (F.col("split") != "train")) | ((F.col("num") > 10) & (F.col("split") != "test")))
    assert bad.count() == 0


def test_split_quota_top_n(spark, rows):
    named = rows.select("vec_id", "class_name", F.concat("class_name", F.lit("_"), F.col("num").cast("string")).alias("file_name"))
    q = splits.split_quota(named, 4, order_cols=("file_name",))
    local = named.collect()
    want = {}
    for c in {r["class_name"] for r in local}:
        names = sorted(r["file_name"] for r in local if r["class_name"] == c)
        want.update({n: ("train" if i < 4 else "test") for i, n in enumerate(names)})
    got = {r["file_name"]: r["split"] for r in q.collect()}
    assert got == want
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "AdaptiveSparkPlan" in plan


def test_sweep_counts_brute_force(rows):
    got = {(r["size"], r["class_name"], r["split"]): r["n_rows"] for r in splits.sweep_counts(rows, SIZES).collect()}
    local = rows.select("class_name", "num").collect()
    want = Counter()
    for s in SIZES:
        for r in local:
            want[(s, r["class_name"], "train" if r["num"] <= s else "test")] += 1
    for k, v in got.items():
        assert want.get(k, 0) == v
    assert sum(got.values()) == len(local) * len(SIZES)


def test_sweep_rows_is_theta_join(rows):
    sw = splits.sweep_rows(rows, SIZES)
    assert sw.count() == sum(rows.filter(F.col("num") <= s).count() for s in SIZES)
    plan = sw._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan


def test_misclassified_and_counts(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)], "label double, prediction double")
    assert splits.misclassified(df).count() == 2
    r = metrics.error_counts(df).first()
    assert (r["n_rows"], r["n_wrong"], r["error_rate"], r["success_pct"]) == (4, 2, 0.5, 50.0)


def test_rounding_is_exact_half_up(spark):
    # 97.125 % must print 97.13 (exact rational, half up); 0 rows -> null
    df = spark.createDataFrame([(800, 23), (0, 0), (3, 1)], "n long, w long")
    got = [r[0] for r in df.select(metrics.success_pct("n", "w")).collect()]
    assert got == [97.13, None, 66.67]


def test_class_counts(rows):
    got = {r["class_name"]: r["n_rows"] for r in metrics.class_counts(rows).collect()}
    assert sum(got.values()) == rows.count() and len(got) == 10


def test_rates_are_exact_for_very_many_rows(spark):
    from fractions import Fraction

    pairs = [(4 * 10**11 + 7, 123_456_789_012), (9 * 10**15, 3 * 10**15 + 1), (2**62, 1), (10**10, 4_999_950_000)]
    df = spark.createDataFrame(pairs, "n long, w long")
    got = df.select(metrics.error_rate("n", "w"), metrics.success_pct("n", "w")).collect()
    for (n, w), (rate, pct) in zip(pairs, got):
        half_up = lambda x: (2 * x.numerator + x.denominator) // (2 * x.denominator)
        assert rate == half_up(Fraction(w, n) * 10**6) / 10**6
        assert pct == half_up(Fraction(n - w, n) * 10**4) / 100


def test_missing_predictions_are_wrong(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, None), (0.0, 1.0)], "label double, prediction double")
    assert metrics.error_counts(df).first()["n_wrong"] == 2


def test_split_quota_of_repeated_names(spark):
    df = spark.createDataFrame([("a", "x.jpg", 1), ("a", "x.jpg", 2), ("a", "x.jpg", 3), ("a", "y.jpg", 4)], "class_name string, file_name string, id int")
    got = splits.split_quota(df, 2, order_cols=("file_name",)).collect()
    assert sorted(r["id"] for r in got) == [1, 2, 3, 4]
    assert sum(r["split"] == "train" for r in got) == 2 and {r["split"] for r in got if r["id"] == 4} == {"test"}


def test_split_quota_partitions_do_not_matter(rows):
    named = rows.select("vec_id", "class_name",
                        F.concat("class_name", F.lit("_"), F.col("num").cast("string")).alias("file_name"))
    one = {r["file_name"]: r["split"] for r in splits.split_quota(named.coalesce(1), 5, order_cols=("file_name",)).collect()}
    two = {r["file_name"]: r["split"] for r in splits.split_quota(named.repartition(12), 5, order_cols=("file_name",), buckets=3).collect()}
    assert one == two and sum(v == "train" for v in one.values()) == 50


def test_stored_label_map_keeps_its_indexes(spark, shared):
    from curvelab.operators import labels as lab

    path = shared("labels")
    load = lambda *names: spark.createDataFrame([(n,) for n in names], "class_name string")
    read = lambda m: {r["class_name"]: r["label_idx"] for r in m.collect()}
    assert read(lab.update_label_map(load("m", "f", "f", None), path)) == {"f": 0, "m": 1}
    assert read(lab.update_label_map(load("a", "m", "z"), path)) == {"f": 0, "m": 1, "a": 2, "z": 3}
    assert read(lab.update_label_map(load("f"), path)) == {"f": 0, "m": 1, "a": 2, "z": 3}
    assert read(lab.update_label_map(load("b", "g", "a"), path)) == {"f": 0, "m": 1, "a": 2, "z": 3, "b": 4, "g": 5}
    assert read(spark.read.parquet(path)) == {"f": 0, "m": 1, "a": 2, "z": 3, "b": 4, "g": 5}
