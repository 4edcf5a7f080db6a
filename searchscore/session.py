"""Session defaults and the shared checkpoint folder."""
from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings a caller may want on a fresh session. On a cluster the session is
# created by the platform and these are only read, never forced.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stemming batches carry whole descriptions: fewer rows per Arrow batch
    # keep a batch's Python memory bounded when texts are long.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # Remove reliable checkpoint files once their DataFrame is unreachable.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "searchscore", extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with AQE and skew-join handling switched on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must already point at shared storage, and it is only read.
    When it is unset (local tests) a private scratch folder is registered with
    the SparkContext (the config itself cannot change at runtime).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on a cluster")
        current = tempfile.mkdtemp(prefix="searchscore-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def cut_lineage(df, spark: SparkSession | None = None):
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    spark = spark or df.sparkSession
    checkpoint_dir(spark)
    return df.checkpoint(eager=True)
