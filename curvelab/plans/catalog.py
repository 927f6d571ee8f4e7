"""Registered queries: one per operator of the inventory, each over the whole
given tables (``embeddings``, ``documents``, ``labels``).

Every function takes ``(spark, sf_dir)`` and returns a DataFrame whose
column names equal those of the matching oracle SQL in ``oracle.py``.
Floating outputs are rounded, rates come from integer counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvelab.functions import (
    base_name,
    class_and_num,
    class_from_first_digit,
    encode_feature_json,
    encode_labeled_line,
    label_1v1,
    label_1vall,
    quantize,
)
from curvelab.operators import labels as lab
from curvelab.operators import metrics, splits
from curvelab.operators import models as model_table
from curvelab.operators import score as scoring
from curvelab.operators import svm
from curvelab.operators.featurize import text_features
from curvelab.operators.ordinal import class_ordinal_head
from curvelab.operators.svm import TASK_1V1, TASK_1VALL, ModelSpec
from curvelab.plans import curves
from curvelab.plans.fixtures import class_rows, curve_rows, files, lines, plain_rows, read_table
from curvelab.plans.requests import class_check
from curvelab.sources.readers import parse_feature_json, parse_feature_lines, parse_labeled_lines

# The training sizes of the published sweep.
PUBLISHED_SIZES = [3, 5, 7, 10, 13, 16, 20, 25, 30, 40, 50, 60, 70, 80, 90, 100]
# Sizes small enough for every class of the smallest text table to keep test rows.
LANG_SIZES = [3, 5, 10, 16]


def _rows(spark, sf_dir) -> DataFrame:
    return class_rows(spark, sf_dir)


def _curve_rows(spark, sf_dir, sizes) -> DataFrame:
    """Rows for queries whose ``num`` only meets sizes <= max(sizes) and is not output."""
    return curve_rows(spark, sf_dir, max(sizes))


# ---------------------------------------------------------------- P1-P3


def q_class_rows(spark, sf_dir):
    """Per-class ordinal (the fixture every split uses)."""
    return _rows(spark, sf_dir).select("vec_id", "class_name", "num")


def q_base_name(spark, sf_dir):
    f = files(spark, sf_dir)
    return f.select("vec_id", "path", base_name("path").alias("base_name"))


def q_class_from_first_digit(spark, sf_dir):
    r = _rows(spark, sf_dir)
    name = F.concat_ws("", "class_name", F.lit("_"), F.col("num").cast("string"), F.lit(".jpg.json"))
    digit_first = F.concat(F.col("num").cast("string"), F.lit("_"), F.col("class_name"), F.lit(".json"))
    no_digit = F.concat(F.col("class_name"), F.lit(".json"))
    return r.select(
        "vec_id",
        name.alias("file_name"),
        class_from_first_digit(name).alias("class_name"),
        class_from_first_digit(digit_first).alias("class_digit_first"),
        class_from_first_digit(no_digit).alias("class_no_digit"),
    )


def q_class_and_num(spark, sf_dir):
    r = _rows(spark, sf_dir)
    good = F.concat(F.col("class_name"), F.lit("_"), F.col("num").cast("string"), F.lit(".jpg"))
    no_sep = F.concat(F.col("class_name"), F.col("num").cast("string"), F.lit(".jpg"))
    bad_suffix = F.concat(F.col("class_name"), F.lit("_"), F.col("num").cast("string"), F.lit(".png"))
    g, n, b = class_and_num(good), class_and_num(no_sep), class_and_num(bad_suffix)
    return r.select(
        "vec_id",
        g.getField("class_name").alias("class_name"),
        g.getField("num").alias("num"),
        n.getField("class_name").alias("nosep_class"),
        n.getField("num").alias("nosep_num"),
        b.getField("class_name").alias("png_class"),
    )


# ---------------------------------------------------------------- S1-S3, P4, P9


def _vector_summary(features_col: str):
    f = F.col(features_col)
    return [
        F.size(f).alias("n_dims"),
        F.aggregate(f, F.lit(0.0).cast("double"), lambda a, x: a + x).cast("bigint").alias("sum_q"),
        F.element_at(f, 1).cast("bigint").alias("first_q"),
        F.element_at(f, -1).cast("bigint").alias("last_q"),
    ]


def q_feature_line_roundtrip(spark, sf_dir):
    text = lines(spark, sf_dir)
    parsed = parse_feature_lines(text, col="line")
    return parsed.select("vec_id", "class_name", "num", *_vector_summary("features"))


def q_feature_json_parse(spark, sf_dir):
    r = _rows(spark, sf_dir)
    raw = r.select(
        "vec_id",
        encode_feature_json(quantize("features")).alias("value"),
        F.concat(F.col("class_name"), F.lit("_"), F.col("num").cast("string"), F.lit(".jpg.json")).alias("file_name"),
    )
    parsed = parse_feature_json(raw)
    return parsed.select("vec_id", "file_name", "class_name", "num", "class_first_digit",
                         *_vector_summary("features"))


def q_labeled_line_parse(spark, sf_dir):
    r = plain_rows(spark, sf_dir)
    text = r.select("vec_id", encode_labeled_line(F.col("label"), quantize("features")).alias("value"))
    parsed = parse_labeled_lines(text)
    return parsed.select("vec_id", "label", *_vector_summary("features"))


# ---------------------------------------------------------------- A5, F1-F3, P5-P8, J2


def q_count_rows(spark, sf_dir):
    return metrics.count_rows(plain_rows(spark, sf_dir))


def q_check_classes(spark, sf_dir):
    """F6 on the pass path: the requested classes exist; their row counts."""
    return class_check(plain_rows(spark, sf_dir), ["breed_b", "breed_i"])


def q_class_counts(spark, sf_dir):
    return metrics.class_counts(plain_rows(spark, sf_dir))


def q_split_threshold(spark, sf_dir):
    return splits.split_threshold(_rows(spark, sf_dir), 10).select("vec_id", "class_name", "num", "split")


def q_split_quota(spark, sf_dir):
    r = _rows(spark, sf_dir)
    named = r.select(
        "vec_id",
        F.concat(F.col("class_name"), F.lit("_"), F.col("num").cast("string"), F.lit(".jpg.json")).alias("file_name"),
    ).withColumn("class_name", class_from_first_digit("file_name"))
    out = splits.split_quota(named, 7, class_col="class_name", order_cols=("file_name",))
    return out.select("vec_id", "class_name", "file_name", "split")


def q_filter_two_classes(spark, sf_dir):
    return splits.filter_two_classes(plain_rows(spark, sf_dir), "breed_c", "breed_g").select("vec_id", "class_name")


def q_label_1v1(spark, sf_dir):
    r = splits.filter_two_classes(plain_rows(spark, sf_dir), "breed_c", "breed_g")
    return r.select("vec_id", "class_name", label_1v1("class_name", "breed_c").alias("label"))


def q_label_1vall(spark, sf_dir):
    return plain_rows(spark, sf_dir).select("vec_id", "class_name", label_1vall("class_name", "breed_e").alias("label"))


def q_label_index(spark, sf_dir):
    return lab.label_index(plain_rows(spark, sf_dir)).select("vec_id", "class_name", "label_idx")


def q_label_decode(spark, sf_dir):
    r = plain_rows(spark, sf_dir)
    mapping = lab.label_map(r)
    indexed = lab.label_index(r, mapping=mapping).withColumn("prediction", F.col("label"))
    return lab.label_decode(indexed, mapping).select("vec_id", "prediction", "predicted_class")


def q_sweep_rows(spark, sf_dir):
    return splits.sweep_counts(_curve_rows(spark, sf_dir, PUBLISHED_SIZES), PUBLISHED_SIZES)


# ---------------------------------------------------------------- M1, M2, F5, A1-A4


def _weights_long(models) -> DataFrame:
    return models.select(
        "task_type", "class_a", "class_b", "size", "iters",
        F.posexplode("weights").alias("dim0", "w"),
    ).select("task_type", "class_a", "class_b", "size", "iters",
             (F.col("dim0") + 1).cast("int").alias("dim"), F.round("w", 6).alias("weight"))


def q_svm_weights_1iter(spark, sf_dir):
    r = _curve_rows(spark, sf_dir, [3, 10])
    return _weights_long(svm.train_grouped(r, curves.all_targets(r, [3, 10], 1)))


def q_svm_weights_2iter(spark, sf_dir):
    r = _curve_rows(spark, sf_dir, [3, 10, 5, 20])
    pairs = [ModelSpec(TASK_1V1, "breed_a", "breed_b", s, 2) for s in (5, 20)]
    specs = curves.all_targets(r, [3, 10], 2).union(svm.spec_frame(spark, pairs))
    return _weights_long(svm.train_grouped(r, specs))


def _one_model(rows, spec):
    return svm.train_grouped(rows, [spec]).collect()[0]


def _pair_test_rows(spark, sf_dir, a="breed_a", b="breed_b", size=10):
    r = _curve_rows(spark, sf_dir, [size])
    m = _one_model(r, ModelSpec(TASK_1V1, a, b, size, 1))
    test = splits.filter_two_classes(r, a, b).filter(F.col("num") > size)
    test = test.withColumn("label", label_1v1("class_name", a))
    return scoring.svm_predict(test, m["weights"], m["intercept"], m["threshold"])


def q_svm_predict(spark, sf_dir):
    return _pair_test_rows(spark, sf_dir).select("vec_id", "label", "prediction")


def q_misclassified(spark, sf_dir):
    return splits.misclassified(_pair_test_rows(spark, sf_dir)).select("vec_id", "class_name")


def q_error_rate(spark, sf_dir):
    return metrics.error_counts(_pair_test_rows(spark, sf_dir))


def q_training_error(spark, sf_dir):
    r = _curve_rows(spark, sf_dir, [20])
    m = _one_model(r, ModelSpec(TASK_1VALL, "breed_d", None, 20, 1))
    train = r.filter(F.col("num") <= 20).withColumn("label", label_1vall("class_name", "breed_d"))
    pred = scoring.svm_predict(train, m["weights"], m["intercept"], m["threshold"])
    return metrics.error_counts(pred)


def q_training_error_fit(spark, sf_dir):
    """A4 as the trainer counts it, every class at two sizes."""
    r = _curve_rows(spark, sf_dir, [3, 20])
    trained = svm.train_grouped(r, curves.all_targets(r, [3, 20], 1), errors=True)
    return trained.select("class_a", "size", "n_train", "n_wrong", metrics.error_rate("n_train", "n_wrong").alias("error_rate"))


def q_success_pct(spark, sf_dir):
    r = _curve_rows(spark, sf_dir, [10])
    return curves.learning_curve(r, TASK_1VALL, "all", [10], iters=1).select(
        "class_a", "n_test", "n_wrong", "success_pct"
    )


# ---------------------------------------------------------------- M3-M6, M9, M12, J1


def q_eval_1v1(spark, sf_dir):
    return curves.eval_1v1(_curve_rows(spark, sf_dir, [10]), "breed_a", "breed_b", 10, iters=1)


def q_eval_1vall(spark, sf_dir):
    return curves.eval_1vall(_curve_rows(spark, sf_dir, [7]), "breed_e", 7, iters=1)


def q_learning_curve_1v1(spark, sf_dir):
    r = _curve_rows(spark, sf_dir, PUBLISHED_SIZES)
    return curves.learning_curve(r, TASK_1V1, "breed_c,breed_h", PUBLISHED_SIZES, iters=2)


def q_learning_curve_1vall(spark, sf_dir):
    r = _curve_rows(spark, sf_dir, PUBLISHED_SIZES)
    return curves.learning_curve(r, TASK_1VALL, "all", PUBLISHED_SIZES, iters=2)


def q_learning_curve_iterative(spark, sf_dir):
    """Same curve as ``learning_curve_1vall`` through the distributed per-iteration trainer."""
    r = _curve_rows(spark, sf_dir, PUBLISHED_SIZES)
    return curves.learning_curve(r, TASK_1VALL, "all", PUBLISHED_SIZES, iters=2,
                                 trainer="iterative")


def q_learning_curve_1vall_100(spark, sf_dir):
    """The published sweep at the reference's default 100 iterations, every class as target."""
    r = _curve_rows(spark, sf_dir, PUBLISHED_SIZES)
    return curves.learning_curve(r, TASK_1VALL, "all", PUBLISHED_SIZES)


def q_learning_curve_1v1_100(spark, sf_dir):
    r = _curve_rows(spark, sf_dir, PUBLISHED_SIZES)
    return curves.learning_curve(r, TASK_1V1, "breed_c,breed_h", PUBLISHED_SIZES)


def q_learning_curve_iterative_100(spark, sf_dir):
    r = _curve_rows(spark, sf_dir, PUBLISHED_SIZES)
    return curves.learning_curve(r, TASK_1VALL, "all", PUBLISHED_SIZES, trainer="iterative")


def q_svm_weights_stop(spark, sf_dir):
    """Weights when the stop rule fires early (tolerance 0.05)."""
    r = _curve_rows(spark, sf_dir, [5, 30, 20])
    specs = [ModelSpec(TASK_1VALL, c, None, s, 100) for c in ("breed_a", "breed_f") for s in (5, 30)]
    specs += [ModelSpec(TASK_1V1, "breed_b", "breed_c", 20, 100)]
    m = svm.train_grouped(r, specs, tol=0.05)
    return m.select(
        "task_type", "class_a", "class_b", "size", "iters", "iters_run",
        F.posexplode("weights").alias("dim0", "w"),
    ).select("task_type", "class_a", "class_b", "size", "iters", "iters_run",
             (F.col("dim0") + 1).cast("int").alias("dim"), F.round("w", 6).alias("weight"))


def q_curve_table(spark, sf_dir):
    c = curves.learning_curve(_curve_rows(spark, sf_dir, PUBLISHED_SIZES), TASK_1VALL, "breed_a", PUBLISHED_SIZES,
                              iters=1)
    return metrics.curve_table(c)


# Model keys that count as already trained in the J1 / M6 queries.
TRAINED_KEYS = [
    (TASK_1VALL, "breed_a", None, 3, 10),
    (TASK_1VALL, "breed_b", None, 3, 100),
    (TASK_1VALL, "breed_c", None, 5, 10),
    (TASK_1V1, "breed_a", "breed_b", 3, 10),
]


def _requested_keys(rows: DataFrame) -> DataFrame:
    """All one-vs-all keys for the classes present, sizes 3/5/10, iterations 10/100."""
    classes = rows.select("class_name").distinct()
    return classes.select(
        F.lit(TASK_1VALL).alias("task_type"),
        F.col("class_name").alias("class_a"),
        F.lit(None).cast("string").alias("class_b"),
        F.explode(F.array(F.lit(3), F.lit(5), F.lit(10))).alias("size"),
    ).select("*", F.explode(F.array(F.lit(10), F.lit(100))).alias("iters")).withColumn(
        "data_version", F.lit("v1")
    )


def q_missing_models(spark, sf_dir):
    r = plain_rows(spark, sf_dir)
    stored = spark.createDataFrame([k + ("v1",) for k in TRAINED_KEYS], model_table.KEY_SCHEMA)
    return model_table.missing_models(_requested_keys(r), stored).drop("data_version")


def q_get_or_train(spark, sf_dir):
    """M6 through a model table in the shared folder: one key stored beforehand,
    the others trained, appended and read back."""
    from curvelab.session import shared_path

    r = _curve_rows(spark, sf_dir, [3, 5, 10])
    path = shared_path(spark, "models")
    first = [ModelSpec(TASK_1V1, "breed_a", "breed_b", 3, 1)]
    model_table.save_models(model_table.with_version(svm.train_grouped(r, first), "v1"), path)
    specs = [ModelSpec(TASK_1V1, "breed_a", "breed_b", s, 1) for s in (3, 5, 10)]
    got = model_table.get_or_train(r, specs, path, "v1", lambda rows, sp: svm.train_grouped(rows, sp))
    return got.select("task_type", "class_a", "class_b", "size", "iters", "n_train")


def q_classify_records(spark, sf_dir):
    r = _curve_rows(spark, sf_dir, [10])
    trained = svm.train_grouped(r, curves.all_targets(r, [10], 1))
    records = r.filter(F.col("num") > 10)
    return scoring.classify_records(records, trained, "vec_id").select("vec_id", "predicted_class")


def q_classify_sub_classes(spark, sf_dir):
    """M9 with up to 100 classes a label: a class is the rows of a label with one remainder of ``vec_id``, its model
    the negated sum of their whole-number vectors, with their number as intercept; all rows are classified by ball trees."""
    whole = read_table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("double")).alias("features")
    )
    name = F.concat_ws("_", "label", F.lpad(F.pmod("vec_id", F.lit(100)).cast("string"), 2, "0"))
    entries = whole.select(name.alias("class_a"), "vec_id", F.posexplode("features").alias("at", "x"))
    sums = entries.groupBy("class_a", "at").agg(F.sum("x").alias("x"), F.count(F.lit(1)).alias("n"))
    models = sums.groupBy("class_a").agg(
        F.sort_array(F.collect_list(F.struct("at", "x"))).alias("w"), F.max("n").cast("double").alias("intercept")
    )
    models = models.select(
        F.lit(TASK_1VALL).alias("task_type"), "class_a", F.lit(None).cast("string").alias("class_b"), F.lit(0).alias("size"),
        F.lit(0).alias("iters"), F.transform("w", lambda e: 0.0 - e["x"]).alias("weights"), "intercept", F.lit(0.0).alias("threshold"),
    )
    return scoring.classify_records(whole, models, "vec_id", search="tree")


# ---------------------------------------------------------------- M10, text curves, M7, M8


def block_pool_factory(blocks: int = 8):
    """Stand-in for a pretrained extractor: sums of consecutive blocks of the input
    vector (64 -> 8 dims).  Built once per task, applied to whole Arrow batches."""
    import numpy as np

    def model(batch):
        X = np.stack(batch.to_numpy()).astype(np.float64)
        return X.reshape(len(X), blocks, -1).sum(axis=2)

    return model


def q_featurize_model(spark, sf_dir):
    from curvelab.operators.featurize import featurize

    emb = read_table(spark, sf_dir, "embeddings")
    out = featurize(emb.select("vec_id", F.col("embedding").cast("array<double>").alias("raw")),
                    block_pool_factory, "raw", dims=8)
    return out.select("vec_id", F.posexplode("features").alias("dim0", "v")).select(
        "vec_id", (F.col("dim0") + 1).cast("int").alias("dim"), F.round("v", 6).alias("value"))


def q_skip_if_featurized(spark, sf_dir):
    """Documents still to featurize when the rows of ``labels`` stand for an
    existing feature table."""
    from curvelab.operators.featurize import skip_if_featurized

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang")
    done = read_table(spark, sf_dir, "labels").select("doc_id")
    return skip_if_featurized(docs, done, key="doc_id")


def _documents(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")


def q_featurize_text(spark, sf_dir):
    """Every non-zero feature of every document (whole text), 6 decimals."""
    feats = text_features(_documents(spark, sf_dir))
    return feats.select("doc_id", F.posexplode("features").alias("dim0", "v")).where(F.col("v") != 0).select(
        "doc_id", (F.col("dim0") + 1).cast("int").alias("dim"), F.round("v", 6).alias("value"))


def lang_rows(spark, sf_dir, upto: int = max(LANG_SIZES)) -> DataFrame:
    """Number each language's documents by ``doc_id`` (exact up to ``upto``, see
    ``class_ordinal_head``: only texts of the key ranges that hold a language's first rows are
    shuffled), featurize every whole text once and keep the result as a written table in the
    shared folder (training reads ``num <= max(size)`` with pushdown, scoring streams the
    whole table)."""
    from curvelab.session import materialize

    numbered = class_ordinal_head(_documents(spark, sf_dir), "lang", "doc_id", upto, out_col="num")
    feats = text_features(numbered)
    return materialize(feats.select(F.col("lang").alias("class_name"), "num", "features", "doc_id"), "lang_rows")


def q_learning_curve_lang(spark, sf_dir):
    return curves.learning_curve(lang_rows(spark, sf_dir), TASK_1VALL, "all", LANG_SIZES)


def q_learning_curve_quality(spark, sf_dir):
    """``labels.quality`` as the class: 1 vs 1 between quality 0 and 1 on text features."""
    from curvelab.session import materialize

    # the texts become vectors where they are read; only vectors meet the labels
    feats = text_features(_documents(spark, sf_dir)).select("doc_id", "features")
    lbl = read_table(spark, sf_dir, "labels").select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("quality"))
    joined = materialize(feats.join(lbl, "doc_id"), "quality_features", cluster_by=None)
    numbered = class_ordinal_head(joined, "quality", "doc_id", max(LANG_SIZES), out_col="num")
    rows = materialize(numbered.select(F.col("quality").alias("class_name"), "num", "features"), "quality_rows")
    return curves.learning_curve(rows, TASK_1V1, "q0,q1", LANG_SIZES)


def q_train_local(spark, sf_dir):
    from curvelab.plans.local import train_local
    from curvelab.session import shared_path

    r = _rows(spark, sf_dir)
    named = r.select(
        F.concat(F.col("class_name"), F.lit("_"), F.col("num").cast("string"), F.lit(".jpg.json")).alias("file_name"),
        "features",
    )
    return train_local(named, 10, shared_path(spark, "local"), classes=None, iters=20)


def q_saved_model_test(spark, sf_dir):
    from curvelab.plans.local import test_saved, train_local
    from curvelab.session import shared_path

    r = _rows(spark, sf_dir)
    named = r.select(
        F.concat(F.col("class_name"), F.lit("_"), F.col("num").cast("string"), F.lit(".jpg.json")).alias("file_name"),
        "features",
    )
    out = shared_path(spark, "local")
    train_local(named, 10, out, classes=("breed_a", "breed_b"), iters=20).collect()
    return test_saved(spark, out, classes=("breed_a", "breed_b"))


def q_saved_model_test_all(spark, sf_dir):
    """M8 with every class: one saved one-vs-all model a class, the lowest margin names the class."""
    from curvelab.plans.local import test_saved, train_local
    from curvelab.session import shared_path

    r = _rows(spark, sf_dir)
    named = r.select(
        F.concat(F.col("class_name"), F.lit("_"), F.col("num").cast("string"), F.lit(".jpg.json")).alias("file_name"),
        "features",
    )
    out = shared_path(spark, "local")
    train_local(named, 10, out, classes=None, iters=20).collect()
    return test_saved(spark, out)


# The gap queries drop the first rows of each class, so the smaller size has no training rows.
GAP_FROM, GAP_SIZES = 41, [3, 43]


def _gap_rows(spark, sf_dir):
    return _curve_rows(spark, sf_dir, GAP_SIZES + [GAP_FROM]).filter(F.col("num") >= GAP_FROM)


def q_learning_curve_gap(spark, sf_dir):
    """A curve with a size below every number: that size has no model and no rates."""
    return curves.learning_curve(_gap_rows(spark, sf_dir), TASK_1VALL, "all", GAP_SIZES, iters=2, trainer="grouped")


def q_learning_curve_gap_iterative(spark, sf_dir):
    return curves.learning_curve(_gap_rows(spark, sf_dir), TASK_1VALL, "all", GAP_SIZES, iters=2, trainer="iterative")


def q_split_quota_large(spark, sf_dir):
    """F3 with a quota above a thousand rows a class."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang")
    return splits.split_quota(docs, 1001, class_col="lang", order_cols=("doc_id",))


def q_split_quota_appended(spark, sf_dir):
    """F3 over three loads whose keys fall between each other's, by stored counts."""
    from curvelab.operators.stored_ordinals import append_counts, split_quota_stored
    from curvelab.session import shared_path

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("doc_id").cast("string").alias("file_name"))
    path = shared_path(spark, "ordinals")
    for load in range(3):
        append_counts(docs.where(F.col("doc_id") % 3 == load), path, str(load), "lang", ["file_name"])
    return split_quota_stored(docs, path, 60, "lang", ["file_name"]).select("doc_id", "lang", "split")


# ---------------------------------------------------------------- files: S1, S3-S5, K3, K5, F4, M11, M13


def q_feature_line_files(spark, sf_dir):
    """The feature table written as ``class,num,f1, f2`` text and read back from its files."""
    from curvelab.session import shared_path
    from curvelab.sinks.writers import write_features
    from curvelab.sources.readers import read_feature_lines

    r = _rows(spark, sf_dir).select("class_name", "num", quantize("features").alias("features"))
    path = shared_path(spark, "feature_lines")
    write_features(r, path, fmt="lines")
    return read_feature_lines(spark, path, glob="*.txt").select("class_name", "num", *_vector_summary("features"))


def _written_json(spark, sf_dir) -> str:
    """One JSON file per vector, ``<class>_<num>.jpg.json``; returns the folder."""
    from curvelab.session import shared_path
    from curvelab.sinks.files import write_files

    r = _rows(spark, sf_dir).select(
        F.concat(F.col("class_name"), F.lit("_"), F.col("num").cast("string"), F.lit(".jpg.json")).alias("name"),
        encode_feature_json(quantize("features")).alias("body"),
    )
    path = shared_path(spark, "json")
    write_files(r, path, "name", "body")
    return path


def q_feature_json_files(spark, sf_dir):
    """One JSON array per file, read back by a name pattern."""
    from curvelab.sources.readers import read_feature_json

    rows = read_feature_json(spark, _written_json(spark, sf_dir), glob="breed_[a-e]_*.jpg.json")
    return rows.select("file_name", "class_name", "num", "class_first_digit", *_vector_summary("features"))


def _written_images(spark, sf_dir) -> str:
    """One file per vector, ``<class>_<num>.jpg``, whose bytes are the vector's text; returns the folder."""
    from curvelab.session import shared_path
    from curvelab.sinks.files import write_files

    r = _rows(spark, sf_dir).select(
        F.concat(F.col("class_name"), F.lit("_"), F.col("num").cast("string"), F.lit(".jpg")).alias("name"),
        encode_feature_json(quantize("features")).alias("body"),
    )
    path = shared_path(spark, "images")
    write_files(r, path, "name", "body")
    return path


def q_read_images(spark, sf_dir):
    """Image files with class, number and bytes."""
    from curvelab.sources.readers import read_images

    images = read_images(spark, _written_images(spark, sf_dir))
    return images.select(
        base_name("path").alias("file_name"), "class_name", "num", "length", F.md5("content").alias("md5")
    )


def q_list_inputs(spark, sf_dir):
    """Files listed by a name pattern, bodies unread."""
    from curvelab.sources.readers import list_inputs

    return list_inputs(spark, _written_images(spark, sf_dir), glob="breed_[f-j]_*.jpg").select("file_name", "length")


def byte_sums_factory():
    """Stand-in for a pretrained extractor of images: length and byte sum of a file."""
    import numpy as np

    return lambda batch: np.array([[float(len(b)), float(np.frombuffer(b, np.uint8).sum())] for b in batch])


def q_new_image_features(spark, sf_dir):
    """M11 over files: the images whose features the table lacks are opened and featurized."""
    from curvelab.plans.jobs import new_image_features
    from curvelab.session import shared_path

    done = _rows(spark, sf_dir).where(F.col("num") % 2 == 0).select(
        F.concat(F.col("class_name"), F.lit("_"), F.col("num").cast("string"), F.lit(".jpg")).alias("file_name")
    )
    table = shared_path(spark, "features")
    done.write.parquet(table)
    new = new_image_features(spark, _written_images(spark, sf_dir), table, byte_sums_factory, dims=2)
    return new.select("file_name", "class_name", "num", F.element_at("features", 1).cast("bigint").alias("n_bytes"),
                      F.element_at("features", 2).cast("bigint").alias("byte_sum"))


def q_write_results(spark, sf_dir):
    """K5: the curves of two targets written as ``size,success`` files and read back."""
    from curvelab.session import shared_path
    from curvelab.sinks.writers import read_results, write_results

    curve = curves.learning_curve(_curve_rows(spark, sf_dir, [3, 10, 30]), TASK_1VALL, ["breed_a", "breed_d"], [3, 10, 30], iters=1)
    path = shared_path(spark, "results")
    write_results(curve, path)
    return read_results(spark, path)


def q_validate_request(spark, sf_dir):
    """A request made of every row of the table, and why it is refused."""
    from curvelab.plans.requests import request_verdict

    r = plain_rows(spark, sf_dir)
    n = F.col("vec_id")
    other = F.concat(F.lit("breed_"), F.chr(F.lit(97) + n % 10))
    requests = r.select(
        "vec_id",
        F.when(n % 3 != 0, F.when(n % 7 == 0, F.col("class_name")).otherwise(F.concat("class_name", F.lit(", "), other))).alias("pair"),
        F.when((n % 3 == 0) | (n % 11 == 0), F.col("class_name")).alias("target"),
        F.concat((n % 5).cast("string"), F.lit(","), F.when(n % 13 == 0, "x").otherwise(n.cast("string"))).alias("sizes"),
        (n % 17 == 0).alias("train"),
        (n % 2 == 0).alias("test"),
        F.lit(False).alias("check"),
    )
    return requests.select("vec_id", request_verdict("pair", "target", "sizes", "train", "test", "check").alias("refused"))


def q_rejected_rows(spark, sf_dir):
    """Rows that no model sees, with the reason: every ninth name, tenth number and eleventh vector is spoilt."""
    from curvelab.plans.requests import rejected_rows

    n = F.col("vec_id")
    r = _rows(spark, sf_dir)
    name = F.concat(F.col("class_name"), F.when(n % 9 == 0, "-").otherwise("_"), F.col("num").cast("string"), F.lit(".jpg"))
    named = class_and_num(name)
    spoilt = r.select(
        "vec_id",
        named.getField("class_name").alias("class_name"),
        F.when(n % 10 != 0, named.getField("num")).alias("num"),
        F.when(n % 11 != 0, F.col("features")).otherwise(F.slice("features", 1, 3)).alias("features"),
    )
    return rejected_rows(spoilt, 64).select("vec_id", "reason")


def q_label_index_appended(spark, sf_dir):
    """P7 with a stored dictionary: three loads, the second and third with classes that sort between old ones."""
    from curvelab.session import shared_path

    r = plain_rows(spark, sf_dir)
    path = shared_path(spark, "label_map")
    for load in (r.where(F.col("label").isin(2, 5, 7)), r.where(F.col("label") != 0), r):
        mapping = lab.update_label_map(load, path)
    return lab.label_index(r, mapping=mapping).select("vec_id", "class_name", "label_idx")


def strict_number_factory():
    """A model that refuses a whole batch for one bad input."""
    import numpy as np

    def model(batch):
        return np.array([[float(int(x))] for x in batch])

    return model


def q_featurize_failures(spark, sf_dir):
    """M10 with planted inputs that the model refuses: they come back with the reason, all others with vectors."""
    from curvelab.operators.featurize import featurize_apart

    r = plain_rows(spark, sf_dir).select(
        "vec_id", F.when(F.col("vec_id") % 13 == 5, "broken").otherwise(F.col("vec_id").cast("string")).alias("raw")
    )
    found = featurize_apart(r, strict_number_factory, "raw", dims=1)
    return found.select("vec_id", F.element_at("features", 1).alias("value"), "reason")


def q_curve_1vall_gram(spark, sf_dir):
    """M5 through the trainer in the space of inner products."""
    rows = _curve_rows(spark, sf_dir, [3, 10])
    return curves.learning_curve(rows, TASK_1VALL, "all", [3, 10], iters=100, trainer="gram")


QUERIES = {
    "class_rows": q_class_rows,
    "base_name": q_base_name,
    "class_from_first_digit": q_class_from_first_digit,
    "class_and_num": q_class_and_num,
    "feature_line_roundtrip": q_feature_line_roundtrip,
    "feature_json_parse": q_feature_json_parse,
    "labeled_line_parse": q_labeled_line_parse,
    "count_rows": q_count_rows,
    "check_classes": q_check_classes,
    "class_counts": q_class_counts,
    "split_threshold": q_split_threshold,
    "split_quota": q_split_quota,
    "filter_two_classes": q_filter_two_classes,
    "label_1v1": q_label_1v1,
    "label_1vall": q_label_1vall,
    "label_index": q_label_index,
    "label_index_appended": q_label_index_appended,
    "label_decode": q_label_decode,
    "sweep_rows": q_sweep_rows,
    "svm_weights_1iter": q_svm_weights_1iter,
    "svm_weights_2iter": q_svm_weights_2iter,
    "svm_predict": q_svm_predict,
    "misclassified": q_misclassified,
    "error_rate": q_error_rate,
    "training_error": q_training_error,
    "training_error_fit": q_training_error_fit,
    "success_pct": q_success_pct,
    "eval_1v1": q_eval_1v1,
    "eval_1vall": q_eval_1vall,
    "learning_curve_1v1": q_learning_curve_1v1,
    "learning_curve_1vall": q_learning_curve_1vall,
    "learning_curve_iterative": q_learning_curve_iterative,
    "learning_curve_1vall_100": q_learning_curve_1vall_100,
    "learning_curve_1v1_100": q_learning_curve_1v1_100,
    "learning_curve_iterative_100": q_learning_curve_iterative_100,
    "svm_weights_stop": q_svm_weights_stop,
    "curve_table": q_curve_table,
    "missing_models": q_missing_models,
    "get_or_train": q_get_or_train,
    "classify_records": q_classify_records,
    "classify_sub_classes": q_classify_sub_classes,
    "featurize_model": q_featurize_model,
    "skip_if_featurized": q_skip_if_featurized,
    "featurize_text": q_featurize_text,
    "learning_curve_lang": q_learning_curve_lang,
    "learning_curve_quality": q_learning_curve_quality,
    "train_local": q_train_local,
    "saved_model_test": q_saved_model_test,
    "saved_model_test_all": q_saved_model_test_all,
    "learning_curve_gap": q_learning_curve_gap,
    "learning_curve_gap_iterative": q_learning_curve_gap_iterative,
    "split_quota_large": q_split_quota_large,
    "split_quota_appended": q_split_quota_appended,
    "feature_line_files": q_feature_line_files,
    "feature_json_files": q_feature_json_files,
    "read_images": q_read_images,
    "list_inputs": q_list_inputs,
    "new_image_features": q_new_image_features,
    "write_results": q_write_results,
    "validate_request": q_validate_request,
    "rejected_rows": q_rejected_rows,
    "featurize_failures": q_featurize_failures,
    "curve_1vall_gram": q_curve_1vall_gram,
}
