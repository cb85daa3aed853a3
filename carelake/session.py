"""Session construction and cluster-facing settings."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every plan in this package relies on.  AQE re-plans joins at
# run time (broadcast when a side turns out small, skew splitting when a
# key is hot) and coalesces small shuffle partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Arrow for toPandas / pandas UDF batches (arrays arrive as numpy arrays).
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "carelake") -> SparkSession:
    """Return (or create) a session with the package's settings applied.

    On a cluster ``master`` is left to spark-submit; locally pass e.g.
    ``local[8]``.  ``shuffle_partitions`` should be sized so one shuffle
    partition holds roughly 128-256 MB at the target data size.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of BASE_CONF to an existing session."""
    for k, v in BASE_CONF.items():
        if spark.conf.isModifiable(k):  # the others belong to whoever started the session
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables, as the cluster names it.

    Where ``spark.checkpoint.dir`` is absent, a local session (tests) gets a fresh temp
    folder; on a cluster that is an error, since its machines share no local folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        # the setting itself can't be changed in a running session; the context remembers the folder
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="carelake-ckpt-"))
        path = spark.sparkContext.getCheckpointDir()
    return path


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the checkpoint dir for one job's files (Spark's writers create it)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
