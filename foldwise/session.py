"""Session construction and the few session-level settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every query in this package assumes. AQE re-plans joins at runtime (a params
# table that turns out small becomes a broadcast; a skewed partition is split), and the
# session time zone is pinned so timestamps compare equal to the SQL oracle.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "foldwise", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's base settings.

    On a cluster ``master`` is left to spark-submit; locally it defaults to ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    # Python workers (only the optional mapInPandas embedding hook uses them) must import this
    # package; on a cluster ship it with --py-files, locally point the workers at its root.
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [root] + [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    builder = builder.config("spark.executorEnv.PYTHONPATH", os.pathsep.join(dict.fromkeys(paths)))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and scratch tables.

    Uses the cluster's ``spark.checkpoint.dir`` when it is set. Where it is unset, a local session
    (tests) gets a fresh folder under the system temp dir; on a cluster that is an error, since
    executors could not share such a folder.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="foldwise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path for a written intermediate table inside the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{os.getpid()}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Cut lineage: write ``df`` once to the shared checkpoint folder (reliable checkpoint) and
    read it back. Used where one derived table (e.g. fold assignments) feeds several fits, so
    they neither recompute it nor depend on executors that may be lost."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
