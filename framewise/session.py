"""Spark session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "framewise", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    UTC session time, AQE with partition coalescing and skew-join splitting,
    Arrow for the pandas crossings, no UI server.  The master and the number of
    shuffle partitions are left to the cluster's configuration unless given
    (``SPARK_MASTER`` counts as given).  ``spark.checkpoint.dir`` is respected
    when the cluster sets it; only a local session gets a private directory.
    """
    builder = SparkSession.builder
    master = master or os.environ.get("SPARK_MASTER")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    # a local session computes in the driver; elsewhere its memory is the cluster's business
    memory = os.environ.get("SPARK_DRIVER_MEMORY", "8g" if (master or "").startswith("local") else "")
    if memory:
        builder = builder.config("spark.driver.memory", memory)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory of the session.

    A session on one machine (master ``local...``) that names none gets a
    private one.  Elsewhere executors would each write to their own disk, so a
    missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share "
                           f"(master {sc.master} has more than one machine)")
    local = tempfile.mkdtemp(prefix="framewise-ckpt-")
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory below the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/framewise-scratch/{name}-{uuid.uuid4().hex[:12]}"


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint directory and read back: evaluated once however
    often it is used, and kept when executors are lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``framewise`` importable in Python workers (once per context):
    pandas stages reference package functions, so workers must import it.
    The package is zipped and added with ``addPyFile``, which distributes it
    to every executor."""
    sc = spark.sparkContext
    key = (id(sc), sc.applicationId)
    if key in _SHIPPED:
        return
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="framewise-pkg-"), "framewise.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)


_REGISTERED: dict[int, str] = {}


def register_tables(spark: SparkSession, sf_dir: str) -> bool:
    """Expose the driver tables as temp views (lazy parquet scans).
    Returns False when this session already has views for ``sf_dir``."""
    sf_dir = sf_dir.rstrip("/")
    # frame times are zone-less; every conversion to epoch time assumes UTC
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    if _REGISTERED.get(id(spark)) == sf_dir and spark.catalog.tableExists(TABLES[-1]):
        return False
    for t in TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    _REGISTERED[id(spark)] = sf_dir
    return True
