"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
  {"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Queries (100 training iterations, the reference's default):
  curve_1vall_all_classes  one-vs-all curve, every class x 16 published sizes (160 models)
  curve_1v1                one pair x 16 sizes
  curve_1vall_iterative    the 160-model curve through the distributed per-iteration trainer
  curve_lang_flagship      whole-text trigram features of `documents` + one-vs-all curve per language
  classify_records         10 one-vs-all models, every row of the table classified
  class_ordinal            per-class ordinal of the whole table (bucketed, no per-class task)
  sweep_counts             rows per (size, class, split)
Each query is built and run ``$BENCH_REPEATS`` times (default 2); the best time counts.
`reference_style_one_model` (MLlib SVMWithSGD on one size of one class, the reference's
unit of work) is reported beside the total, not in it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from curvelab.operators import score as scoring  # noqa: E402
from curvelab.operators import splits, svm  # noqa: E402
from curvelab.plans import curves  # noqa: E402
from curvelab.plans.catalog import PUBLISHED_SIZES, LANG_SIZES, lang_rows  # noqa: E402
from curvelab.plans.fixtures import class_rows, curve_rows  # noqa: E402
from curvelab.session import local_session  # noqa: E402


REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))  # best of N runs per query


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores=cpus, shuffle_partitions=cpus, app="curvelab-bench")
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]

    def rows():
        return class_rows(spark, sf_dir)

    def crows():
        # curves only compare num with sizes <= 100: only the key ranges that hold them are shuffled
        return curve_rows(spark, sf_dir, max(PUBLISHED_SIZES))

    def classify():
        r = crows()
        models = svm.train_grouped(r, curves.all_targets(r, [100], 100))
        return scoring.classify_records(r, models, "vec_id").groupBy("predicted_class").count()

    jobs = {
        "curve_1vall_all_classes": lambda: curves.learning_curve(crows(), "1vsall", "all", PUBLISHED_SIZES),
        "curve_1v1": lambda: curves.learning_curve(crows(), "1vs1", "breed_a,breed_b", PUBLISHED_SIZES),
        "curve_1vall_iterative": lambda: curves.learning_curve(crows(), "1vsall", "all", PUBLISHED_SIZES,
                                                               trainer="iterative"),
        "curve_lang_flagship": lambda: curves.learning_curve(lang_rows(spark, sf_dir), "1vsall", "all", LANG_SIZES),
        "classify_records": classify,
        "class_ordinal": lambda: rows().select("vec_id", "class_name", "num"),
        "sweep_counts": lambda: splits.sweep_counts(crows(), PUBLISHED_SIZES),
    }
    # warm-up: JVM, Python workers, Arrow
    curves.learning_curve(crows(), "1vs1", "breed_a,breed_b", [3], iters=2).collect()

    times = {}
    for name, build in jobs.items():
        best = None
        for _ in range(REPEATS):
            t0 = time.time()
            df = build()
            if name == "class_ordinal":
                df.write.format("noop").mode("overwrite").save()
            else:
                df.collect()
            took = time.time() - t0
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(f"# {name}: {times[name]} s", file=sys.stderr, flush=True)

    # the reference's unit of work: one MLlib model for one size of one class
    t0 = time.time()
    r = crows().filter(F.col("num") <= 10).withColumn(
        "label", F.when(F.col("class_name") == "breed_a", 0.0).otherwise(1.0))
    svm.train_mllib(r, iters=100)
    ref_one = round(time.time() - t0, 3)

    print(json.dumps({
        "metric": "total_query_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "reference_style_one_model_sec": ref_one,
        "models_per_curve_1vall": 16 * 10,
        "repeats": REPEATS,
    }))


if __name__ == "__main__":
    main()
