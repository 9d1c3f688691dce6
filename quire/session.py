"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings every job here relies on.  AQE coalesces the many small shuffle
# partitions a doc_id exchange produces on small inputs and splits skewed ones
# on large inputs; UTC keeps timestamps identical to the DuckDB oracle.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quire", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests and tools.

    On a cluster the session already exists (spark-submit); this only fills in
    settings that are unset, so the cluster's own configuration wins.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    given = SparkConf()  # what spark-submit passes; a master there means a cluster
    builder = SparkSession.builder.appName(app_name)
    conf = dict(_DEFAULTS)
    if not given.contains("spark.master"):
        builder = builder.master(master or os.environ.get("QUIRE_MASTER", "local[8]"))
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
        conf["spark.driver.memory"] = os.environ.get("QUIRE_DRIVER_MEMORY", "16g")
    conf = {k: v for k, v in conf.items() if not given.contains(k)} | (extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised intermediates.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared, durable
    folder there) or from the context, if the caller has set it.  Where neither
    is set, a local session (all tasks in this process, as in tests) gets a
    scratch folder; on a cluster this raises, because other machines could not
    see one.
    """
    sc = spark.sparkContext
    known = sc._jsc.sc().getCheckpointDir()
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if known.isEmpty():
        if not configured:
            if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="quire-ckpt-")
        sc.setCheckpointDir(configured)
    return configured or known.get()
