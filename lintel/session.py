"""Session helpers.

The engine never creates scratch space on a machine-local folder: anything
that needs durable intermediate storage uses ``spark.checkpoint.dir`` from the
session (the shared folder the cluster names).  Only when that setting is
unset (local tests) do we set one ourselves, when the first feature asks for it.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for the plans the engine builds (all public Spark confs).
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Call-site capture costs a JVM round trip per DataFrame function call; rule compilation
    # makes thousands of them for wide tables.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # HotSpot does not JIT-compile methods over 8000 bytes of bytecode; a rule pack over a wide
    # table makes one whole-stage method that large and it would run interpreted.  With this
    # limit Spark falls back to split, JIT-able expression code for such stages only.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, app_name: str = "lintel", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_local(spark: SparkSession) -> bool:
    """One machine: executors and driver share its folders (a local-cluster does not count)."""
    return spark.sparkContext.master.split("[")[0] == "local"


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the session's checkpoint folder (``spark.checkpoint.dir``).

    Only a local-mode session (tests) gets a folder of its own when none is
    configured; on a cluster a machine-local folder would be wrong, so an
    unset setting is an error for the features that need it.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if fallback is None and not is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage (e.g. HDFS or object store)")
    path = fallback or tempfile.mkdtemp(prefix="lintel-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path
