"""SparkSession construction and the few settings the jobs rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job assumes. Cluster-specific sizing (executor memory, shuffle
# partitions for the data volume) belongs to the deployment, not to this dict.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins below this runtime size become broadcast joins (AQE checks the
    # actual shuffle output, so this is a measured bound, not a guess).
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "folio",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the folio defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the adaptive-execution settings to an already running session
    (e.g. one created by a caller); other settings of that session are kept."""
    for key, value in DEFAULT_CONF.items():
        if key.startswith("spark.sql.adaptive."):
            try:
                spark.conf.set(key, value)
            except Exception:  # static conf on an existing session: keep theirs
                pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, setting a local one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is; a local temporary folder is only created for local test sessions.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="folio-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A folder under the checkpoint directory for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "folio", name)
