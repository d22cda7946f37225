"""Session helpers.

Cluster jobs must cut lineage into a *shared* folder.  We read the folder from
``spark.checkpoint.dir`` (or the SparkContext's checkpoint dir) and only create
our own under ``/tmp`` when running in local mode with nothing configured
(tests, the local bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # long texts yield many windows per input row: keep Arrow batches small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
}
# single-machine sizing: only applied for local masters (a cluster brings its own)
LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.driver.memory": "16g",
}


def get_spark(master: str | None = None, app: str = "chatloom", conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    local = bool(master) and master.startswith("local")
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(LOCAL_CONF if local else {}), **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used for ``DataFrame.checkpoint`` and derived tables."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = sc._jsc.sc().getCheckpointDir()
        d = d.get() if d.isDefined() else None
    if not d:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/…) on a cluster")
        d = tempfile.mkdtemp(prefix="chatloom-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
    # make sure the context writes checkpoints there as well
    cur = sc._jsc.sc().getCheckpointDir()
    if not cur.isDefined():
        sc.setCheckpointDir(d)
    return d


def work_dir(spark: SparkSession, name: str = "work") -> str:
    """A fresh sub-folder of the shared checkpoint folder for derived tables / files."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/chatloom-{name}-{uuid.uuid4().hex[:12]}"
    if "://" not in path or path.startswith("file:"):
        os.makedirs(path.replace("file:", ""), exist_ok=True)
    return path
