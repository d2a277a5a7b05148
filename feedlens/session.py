"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so that dates and 15-minute slots are the same
# in every engine, AQE for runtime re-planning (coalescing, skew joins), no UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "feedlens", extra: dict | None = None) -> SparkSession:
    """A session with the settings above. The master and the shuffle width are set only
    where they are given, so what spark-submit or the cluster has set stands."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is used as is; where it is
    missing there, this raises. Only a local master (tests) gets a scratch folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the setting lives in the session conf
        sc = None
    if sc is None:
        path, master = spark.conf.get("spark.checkpoint.dir", None), "connect"
    else:
        path, master = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir(), sc.master
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir is not set: on {master} it has to name storage that all executors share")
        path = tempfile.mkdtemp(prefix="feedlens-ckpt-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scale_conf(input_bytes: float, total_cores: int, shuffled_share: float = 0.05,
               partition_bytes: int = 256 << 20, most_partitions: int = 20_000) -> dict:
    """Settings for a large cluster run.

    Scan splits are ``partition_bytes``. The shuffle width follows the bytes a job shuffles
    (``shuffled_share`` of what it scans: the jobs here aggregate in the map tasks), is at
    least 3 waves of the cluster's cores, and otherwise at most ``most_partitions``, since
    map tasks x shuffle partitions is the number of blocks to be fetched. AQE coalesces
    small partitions and splits skewed ones at runtime. Streaming state lives in RocksDB.
    """
    wanted = int(input_bytes * shuffled_share // partition_bytes) + 1
    shuffle = max(3 * total_cores, min(wanted, most_partitions))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
        # streaming state (one row per open slot and user) off the JVM heap
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
