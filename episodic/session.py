"""Session construction and the shared scratch folder.

On a cluster the session comes from the launcher with
``spark.checkpoint.dir`` pointing at shared storage; we only read it.
A local folder is created only when the setting is missing (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job relies on. AQE re-plans joins from runtime sizes (so a
# broadcast only happens once the build side is measured small) and splits
# skewed shuffle partitions; timestamps are wall-clock (NTZ) so the zone is
# pinned for date arithmetic on LTZ values.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "episodic") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("EPISODIC_DRIVER_MEM", "16g"))
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder on storage every executor sees (``spark.checkpoint.dir``).

    Read from the session; only when unset and the master is local (tests) a
    fresh local folder is created and registered as the checkpoint dir.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) \
        or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="episodic-ckpt-")
        sc.setCheckpointDir(d)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared folder (never reused, never cleared)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
