"""Session helpers.

The library never creates machine-local scratch space on a cluster: the
checkpoint folder is read from ``spark.checkpoint.dir``; only local sessions
(tests, bench) get a fallback folder when it is unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # call-site capture for error messages inspects the Python stack on every
    # Column call (~1 s per query plan); off for batch runs
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "slotplan", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(_DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cores)
    conf["spark.driver.memory"] = os.environ.get("SLOTPLAN_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # a remote session has no local SparkContext
        return None


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    sc = _context(spark)
    d = sc.getCheckpointDir() if sc is not None else None
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use ``spark.checkpoint.dir``; fall back to a scratch folder only in local mode."""
    sc = _context(spark)
    d = checkpoint_dir(spark)
    if d:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not str(master).startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for it")
    d = tempfile.mkdtemp(prefix="slotplan-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(d)
    else:
        spark.conf.set("spark.checkpoint.dir", d)
    return d
