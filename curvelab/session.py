"""Session helpers: local test sessions and the shared working folder.

Cluster jobs take the shared folder from ``spark.checkpoint.dir`` (set by
whoever launches the cluster).  A folder of our own is created only when the
setting is missing *and* the master is local, which is the test setup.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "curvelab") -> SparkSession:
    """Session used by tests, bench and the smoke entry (local mode)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Shared folder configured and this package importable on every executor."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: dict[str, str] = {}


def ship_package(spark: SparkSession) -> str:
    """Zip the ``curvelab`` package once per application and ``addPyFile`` it, so
    Python workers can import it wherever the driver was started (the same as
    ``--py-files``; a cluster that installs the package may skip this)."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return _SHIPPED[app]
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, dirs, names in os.walk(pkg_dir):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(base, n)
                    zf.write(full, os.path.relpath(full, root))
    out_dir = tempfile.mkdtemp(prefix="curvelab-code-")
    path = os.path.join(out_dir, "curvelab.zip")
    with open(path, "wb") as f:
        f.write(buf.getvalue())
    sc.addPyFile(path)
    _SHIPPED[app] = path
    return path


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, configuring the context if needed."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder every executor can reach"
        )
    path = tempfile.mkdtemp(prefix="curvelab-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared folder (for written tables and scratch output)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    leaf = "/".join(p.strip("/") for p in parts) if parts else ""
    name = f"curvelab-work/{uuid.uuid4().hex}"
    return f"{base}/{name}/{leaf}" if leaf else f"{base}/{name}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def materialize(df, name: str = "table", cluster_by: str | None = "num"):
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts lineage (a lost executor re-reads files instead of recomputing the
    plan) and gives later scans Parquet pushdown and column pruning; rows are
    sorted by ``cluster_by`` inside each task so ``num`` filters skip row groups."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    if cluster_by and cluster_by in df.columns:
        df = df.sortWithinPartitions(cluster_by)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# Largest side that ``bounded_broadcast`` marks for broadcast, as the plain size of its values.
BROADCAST_BYTES = 64 << 20


def bounded_broadcast(df, name: str, max_bytes: int = BROADCAST_BYTES):
    """A join side whose size is known before the join is planned.

    ``df`` is written to the shared folder (``materialize``) and the bytes of its values
    are summed over the written rows; the result carries a broadcast hint only when
    they are at most ``max_bytes``.  Otherwise the planner's shuffle join is left in place."""
    from pyspark.sql import functions as F

    side = materialize(df, name, cluster_by=None)
    width = sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) + F.lit(16) for c in side.columns), F.lit(16))
    total = side.agg(F.sum(width)).first()[0] or 0
    return F.broadcast(side) if total <= max_bytes else side
