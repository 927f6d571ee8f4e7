"""Driver contract: entry smoke, and Spark vs DuckDB oracle on a sample of queries."""

import duckdb
import pytest

import __spark_entry__ as se
from tests.conftest import SF_MID

FAST = ["saved_model_test_all", "learning_curve_gap", "learning_curve_gap_iterative", "split_quota_large", "feature_line_files",
        "feature_json_files", "read_images", "list_inputs", "new_image_features", "write_results", "validate_request",
        "rejected_rows", "class_rows", "class_and_num", "feature_line_roundtrip", "split_quota", "label_decode", "sweep_rows",
        "svm_weights_2iter", "learning_curve_1v1", "missing_models", "classify_records"]


def test_entry_smoke(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert rows and "success_pct" in df.columns


def test_every_oracle_has_a_query():
    assert set(se.oracle_sql()) <= set(se.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("embeddings", "documents", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_MID}/{t}.parquet')")
    return c


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(round(r[i], 9)) if isinstance(r[i], float) else repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", FAST)
def test_oracle_match(spark, con, name):
    df = se.queries()[name](spark, SF_MID)
    res = con.execute(se.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(res.fetchall(), cols)


def test_workers_import_package_from_any_cwd(tmp_path):
    """Python UDFs must find the package even when the driver starts elsewhere."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import importlib.util
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
spec = importlib.util.spec_from_file_location("se", {os.path.join(repo, '__spark_entry__.py')!r})
se = importlib.util.module_from_spec(spec)
spec.loader.exec_module(se)
print("ROWS", len(se.queries()["eval_1v1"](spark, "/root/testdata/sf0.001").collect()))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=str(tmp_path), env=env, capture_output=True,
                         text=True, timeout=600)
    assert "ROWS 1" in out.stdout, out.stderr[-2000:]
