"""Session settings the library relies on.

The library never creates a cluster session on its own: callers pass one.
``configure`` only sets what the engine needs for its semantics (UTC,
ANSI, AQE) and leaves cluster-owned settings (checkpoint dir, shuffle
partitions on a real cluster) alone.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the semantics depend on (time zone for stamps, strict casts,
# runtime re-planning for skew and broadcast decisions).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "tiermart") -> SparkSession:
    """A local session for tests and benchmarks (UI off, no servers), with a scratch folder of its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        # One machine: a fresh local folder is shared by all that take part.
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tiermart-local-"))
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder under the shared one that the cluster names in ``spark.checkpoint.dir``.

    There is no default: a folder local to the driver would be missed by the executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set; name a folder there that the driver and all executors share")
    return f"{root.rstrip('/')}/tiermart/{name}"
