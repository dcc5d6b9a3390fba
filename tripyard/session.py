"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "tripyard",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session configured for the trip lakehouse (UTC, AQE, no UI)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (or None)."""
    value = spark.conf.get(CHECKPOINT_CONF, None)
    if value:
        return value.rstrip("/")
    sc_dir = spark.sparkContext.getCheckpointDir()
    return sc_dir.rstrip("/") if sc_dir else None


def ensure_checkpoint_dir(spark: SparkSession, fallback_prefix: str = "tripyard-ckpt-") -> str:
    """Return the configured checkpoint folder; in a plain local session without one, set a private one.

    On a cluster the folder must come from the session configuration: a folder made
    here would be another one on each machine.
    """
    root = checkpoint_root(spark)
    if root:
        return root
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
    root = tempfile.mkdtemp(prefix=fallback_prefix)
    spark.sparkContext.setCheckpointDir(root)
    return root


def cluster_conf(input_bytes: int, executor_cores: int, executors: int) -> dict[str, str]:
    """Starting configuration for a cluster run over ``input_bytes`` of input.

    * splits of 256 MB keep scan tasks long enough to amortise scheduling;
    * shuffle partitions of about 1 GB at the widest shuffle (the silver-sized daily
      summary), never fewer than 2 waves of tasks: smaller ones would make the
      driver's map-output tracking the bottleneck on large inputs.  AQE coalesces
      small partitions and splits skewed ones at run time;
    * the broadcast threshold is a fixed 64 MB of measured size.
    """
    slots = executor_cores * executors
    shuffle_partitions = max(2 * slots, input_bytes // 1024**3)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024**2),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024**2),
        "spark.sql.shuffle.partitions": str(int(shuffle_partitions)),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024**2),
        "spark.sql.session.timeZone": "UTC",
    }
