"""Session construction and shared-storage locations.

Library code never creates its own session when one is passed in; the helpers
here are for tests, the bench and command-line use.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Static settings: only effective when this process creates the context.
STATIC_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Runtime SQL settings: applied only where the cluster / submit command did
# not set them already.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Bound every broadcast by an explicit size: AQE may convert a join to a
    # broadcast join only below this threshold.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ratewise", extra: dict | None = None) -> SparkSession:
    """Get or create a session; explicit arguments win, then the cluster's settings, then ours."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in STATIC_CONF.items():
        builder = builder.config(k, v)
    explicit = dict(extra or {})
    if shuffle_partitions:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in explicit.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configured = spark.sparkContext.getConf()
    for k, v in DEFAULT_CONF.items():
        if k not in explicit and not configured.contains(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` (or a directory already set on the context) wins.
    Where neither is set, a private folder is made and removed at exit, but only
    for a local master: on a cluster each machine would write to its own disk,
    so there the setting is required.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="ratewise-ckpt-")
        atexit.register(shutil.rmtree, conf_dir, ignore_errors=True)
    sc.setCheckpointDir(conf_dir)
    return (sc.getCheckpointDir() or conf_dir).rstrip("/")


def materialize(df):
    """Cut lineage: reliable ``checkpoint()`` into the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, name: str):
    """Cut lineage by compressed columns in a scratch folder: for many narrow rows a fraction of a checkpoint's bytes."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, run-unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base}/ratewise/{name}-{uuid.uuid4().hex[:12]}"
