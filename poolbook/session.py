"""Session construction and lineage cutting.

Everything here respects settings the cluster already made: the checkpoint
folder is read from ``spark.checkpoint.dir`` and only invented (in a fresh
temporary folder) when the session has none, which is the test situation.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: day boundaries in UTC, ANSI arithmetic (decimal
# overflow raises instead of wrapping), and adaptive execution for runtime
# re-planning (partition coalescing, skew-join splitting, broadcast conversion).
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files once their DataFrame is garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Sizing for large clusters (100 TB inputs, ~1000 executors).  Scan splits of
# 256 MB keep task counts in the hundreds of thousands; AQE sizes shuffle
# partitions from measured bytes (advisory 256 MB) starting from a generous
# initial count, splits skewed partitions above 5x the median (and 512 MB), and
# converts joins to broadcasts only below 64 MB measured.  Applied by
# ``build_session(profile="cluster")`` where the cluster has not set them.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.files.maxRecordsPerFile": "20000000",
}


def build_session(
    master: str | None = None,
    app_name: str = "poolbook",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    profile: str = "local",
) -> SparkSession:
    """Get or create a session with the settings the operators assume.

    ``profile="cluster"`` adds ``CLUSTER_CONF`` for settings the cluster's
    own configuration leaves unset."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(CORE_CONF)
    if profile == "cluster":
        from pyspark import SparkConf

        present = dict(SparkConf().getAll())
        conf.update({k: v for k, v in CLUSTER_CONF.items() if k not in present})
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # Spark Connect sessions have no SparkContext
        pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    filesystem); unset on a cluster is an error.  Only for a local master
    (tests) an unset setting gets a fresh temporary folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        if not path:
            raise RuntimeError("spark.checkpoint.dir is not set on the Spark Connect server")
        return path
    if not path:
        master = sc.master
        if not master.startswith("local"):
            # A machine-local folder would not survive executor loss.
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (e.g. on HDFS/S3) for this cluster")
        path = tempfile.mkdtemp(prefix="poolbook-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def checkpoint(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder: survives executor loss and
    cuts the lineage of long plans (never a local checkpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
