"""Session helpers: recommended settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the profile plans rely on.  AQE coalesces the small post-aggregate
# shuffles and splits skewed partitions; UTC keeps printed labels stable.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "strata",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and the bench (no UI, no servers)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (on a cluster: a shared, fault-tolerant
    path).  Only a local session may leave it unset: a fresh folder is then
    made, once per session; on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
            root = None
    if not root:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")
