"""Session construction and the shared scratch area.

Round trips through files (CSV, text, Parquet, saved models) must land in a
folder every executor can see.  On a cluster that folder is the one named by
``spark.checkpoint.dir``; we only pick our own (a fresh local temp folder)
when the session has none and the master is ``local[*]``, as in unit tests.
On any other master a missing setting is an error.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs rely on.  Time zone: epoch <-> text conversions follow
# the session zone in Spark; the jobs pin UTC explicitly in their expressions,
# so this is only a default for ad-hoc use.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "fundscope",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _conf_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        # getCheckpointDir adds a per-application sub folder; use its parent
        return current.rsplit("/", 1)[0]
    return sc.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root, setting a local one only if unset."""
    root = _conf_checkpoint_dir(spark)
    if root:
        try:
            if not spark.sparkContext.getCheckpointDir():
                spark.sparkContext.setCheckpointDir(root)
        except Exception:  # Spark Connect
            pass
        return root
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir is not set and the master is {master}: "
                           "name a folder there that all executors share")
    root = tempfile.mkdtemp(prefix="fundscope-ckpt-")
    spark.sparkContext.setCheckpointDir(root)
    return root


_HAS_SCHEME = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*:")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint root.

    Nothing is created here: Spark writers create the folder themselves, and
    the path may be on any Hadoop file system.
    """
    root = ensure_checkpoint_dir(spark)
    # A URI keeps its scheme (``file:/tmp/x`` has no ``//``); only a bare
    # relative path is made absolute.
    if not _HAS_SCHEME.match(root) and not root.startswith("/"):
        root = os.path.abspath(root)
    return f"{root.rstrip('/')}/fundscope-scratch/{uuid.uuid4().hex}/{name}"
