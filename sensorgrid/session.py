"""Session construction and shared-storage helpers.

Everything in this package is a lazy ``DataFrame -> DataFrame`` function; the
only things that touch the session directly are the builder below and the
scratch/checkpoint folder lookup (which must live on storage every executor
can read, never a machine-local temp dir on a cluster).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on. UTC pins wall-clock semantics of
# ``timestamp_ntz`` round trips through ``date_trunc`` / ``try_to_timestamp``.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sensorgrid", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor, size its heap
        conf["spark.driver.memory"] = os.environ.get("SENSORGRID_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment (a shared filesystem / object
    store path). Only when it is unset (unit tests, local runs) do we create
    one, so a cluster setting is never overridden.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf_dir:
        if not sc.master.startswith("local"):
            # a machine-local folder is invisible to other executors and lost with the host
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store) on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="sensorgrid-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for intermediate files."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint to the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def local_path(p: str) -> str:
    """Strip a ``file:`` scheme so driver-side code can look at local test folders."""
    return p[len("file:"):] if p.startswith("file:") else p


def is_local_fs(p: str) -> bool:
    return p.startswith("file:") or (":" not in p.split("/")[0] and os.path.isabs(p))
