"""Session settings shared by tests, the bench and the driver entry.

On a cluster the session already exists and carries the cluster's own
settings; ``configure`` only fills in what is unset.  The one setting a job
must never invent there is the checkpoint folder: it has to be the shared
folder the cluster names in ``spark.checkpoint.dir``.  A local folder is set
only when the session has none, which is the case in tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every operator relies on.  AQE re-plans joins at each exchange
# (size-checked broadcast, skew split, partition coalescing), which is how
# a hot customer or order key is split at runtime.
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # An aggregate that reuses the partitioning of the join below it would
    # otherwise keep AQE from splitting the join's hot key.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Keep timestamp_ntz semantics independent of where the job runs.
    "spark.sql.session.timeZone": "UTC",
}


# Starting points for a large cluster (~100 TB of facts, ~1000 executors);
# applied by ``configure_for_cluster`` only where the cluster sets nothing.
# Many shuffle partitions plus AQE coalescing gives ~128 MB reduce tasks for
# big stages and few tasks for small ones; a broadcast threshold is an
# explicit size bound on any build side Spark chooses to broadcast.
CLUSTER_DEFAULTS = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
}


def configure_for_cluster(spark: SparkSession) -> SparkSession:
    """``configure`` plus ``CLUSTER_DEFAULTS`` where the cluster leaves them unset."""
    configure(spark)
    explicit = dict(spark.sparkContext.getConf().getAll())
    for key, value in CLUSTER_DEFAULTS.items():
        if key not in explicit:
            spark.conf.set(key, value)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SQL_DEFAULTS`` where the session does not set them itself (a key's
    built-in default is not a setting)."""
    explicit = dict(spark.sparkContext.getConf().getAll())
    for key, value in SQL_DEFAULTS.items():
        if key not in explicit:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The session's checkpoint folder.

    The cluster's ``spark.checkpoint.dir`` when set.  Only a local-mode
    session (tests, the bench) without one gets a folder of its own; on a
    cluster without the setting this returns None rather than inventing a
    machine-local path that executors cannot share.
    """
    sc = spark.sparkContext
    active = sc._jsc.sc().getCheckpointDir()  # scala Option[String]
    if active.isDefined():
        return active.get()
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
        return named
    if not sc.master.startswith("local"):
        return None
    local = tempfile.mkdtemp(prefix="casebook-ckpt-")
    sc.setCheckpointDir(local)
    return local


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "casebook") -> SparkSession:
    """A local session for tests and the bench (UI off, no server opened)."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    parts = shuffle_partitions or cores
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.driver.memory", os.environ.get("CASEBOOK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoint files go with the DataFrames that wrote them
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in SQL_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
