"""Session construction and cluster-facing settings."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Timestamps in the inputs are naive local
# readings that the pipeline treats as UTC, so the session zone is fixed.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcasts happen only (a) for literal lookup tables, marked with
    # F.broadcast, whose size is fixed, or (b) when AQE has *measured* a
    # finished shuffle stage below this threshold. Static planning never
    # broadcasts on an estimate.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "fishladder",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
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


def apply_job_conf(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators assume to an existing session."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.autoBroadcastJoinThreshold",
              "spark.sql.autoBroadcastJoinThreshold"):
        spark.conf.set(k, BASE_CONF[k])
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for lineage cuts.

    The cluster names it in ``spark.checkpoint.dir``; that value always wins.
    A fallback is only used where the setting is absent (local tests).
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if fallback is None:
            raise RuntimeError("spark.checkpoint.dir is not set on this session")
        d = fallback
        os.makedirs(d, exist_ok=True)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def work_folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder for one intermediate table.

    Only a local session may go without ``spark.checkpoint.dir``; its driver
    and workers share one machine and get one temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and spark.sparkContext.master.split("[")[0] == "local":
        named = spark.sparkContext.getCheckpointDir() or checkpoint_dir(spark, tempfile.mkdtemp(prefix="fishladder-"))
    return f"{(named or checkpoint_dir(spark)).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the given files/folders from file-system metadata."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    total = 0
    for p in ([paths] if isinstance(paths, str) else paths):
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += int(path.getFileSystem(conf).getContentSummary(path).getLength())
    return total


# What one task reads, whatever the size of the input: bytes of a scan, shuffled bytes, and
# bytes of the (compressed) input for each partition a shuffle starts from.
TASK_SCAN, TASK_SHUFFLE, TASK_INPUT = 32 << 20, 8 << 20, 8 << 20
# Partitions of a shuffle at most (blocks of map tasks x partitions are tracked by the driver).
MAX_PARTITIONS = 20_000


def bound_tasks(spark: SparkSession, nbytes: int) -> int:
    """Deal the shuffles of a query over an input of ``nbytes`` so that a task's
    hash maps and sorts hold no more when the input grows; returns the partitions.

    With a fixed number of partitions a reduce task's memory grows with the
    input, and so does a scan's up to the 128 MB of a split (which a map-side
    aggregation of unlike keys expands twelvefold). Shuffles start from a
    partition per ``TASK_INPUT`` of input, never fewer than the session's own
    number, and AQE joins small ones up to ``TASK_SHUFFLE``. Smaller sizes set
    by the session stay. Beyond ``MAX_PARTITIONS`` (160 GB) tasks grow again; a
    job of that size sets its own sizes (``size_for_input``).
    """
    conf = spark.conf
    partitions = max(int(conf.get("spark.sql.shuffle.partitions")), min(nbytes // TASK_INPUT + 1, MAX_PARTITIONS))
    conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    for key, most in (("spark.sql.adaptive.advisoryPartitionSizeInBytes", TASK_SHUFFLE),
                      ("spark.sql.files.maxPartitionBytes", TASK_SCAN)):
        if _conf_bytes(spark, key) > most:
            conf.set(key, f"{most}b")
    # the large aggregations have nearly as many keys as rows (tag and site, arrival time); the small
    # map Spark tries first for each row only costs there
    conf.set("spark.sql.codegen.aggregate.map.twolevel.enabled", "false")
    return partitions


def _conf_bytes(spark: SparkSession, key: str) -> int:
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)))


def size_for_input(spark: SparkSession, nbytes: int, target_partition_bytes: int = 256 << 20,
                   expansion: float = 1.0, max_partitions: int | None = None) -> dict:
    """Size shuffles and scan splits for an input of ``nbytes`` (compressed).

    The largest shuffle is assumed to carry about ``expansion`` times the
    compressed input (every big shuffle here follows a map-side reduction).
    AQE starts from enough partitions for ``target_partition_bytes`` each and
    coalesces small ones at run time, so the number only has to be large
    enough. A job whose shuffle service cannot manage that many blocks (map
    tasks x reduce partitions) names its own ``max_partitions``; partitions
    then grow instead. Scan splits stay at 128 MB unless the input is small
    relative to the cores.
    """
    cores = spark.sparkContext.defaultParallelism
    initial = max(cores, int(nbytes * expansion / target_partition_bytes) + 1)
    initial = min(initial, max_partitions or initial)
    split = min(128 << 20, max(4 << 20, nbytes // max(1, cores)))
    conf = {
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(split),
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf
