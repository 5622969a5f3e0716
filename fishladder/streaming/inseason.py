"""Incremental in-season ingest with Structured Streaming.

The in-season job re-reads every detection report each day to find the first
detection per (tag, site). As a stream, newly landed report files are read
once; the running minimum per key lives in the state store, and each
micro-batch writes only the keys whose first detection changed. The log is
partitioned by the stream's identity (fixed by its checkpoint) and the batch:
a retried batch replaces its own output, and no other stream, also not one
started anew, can replace it. ``first_detections`` folds the log into the
current table with one partially combined aggregation; ``compact`` replaces
the log by that table.

The checkpoint lives inside the output folder, one for each landing folder,
unless the caller names another shared folder; so the same landing and output
folders always go on from where they stopped.

The state store keeps one row per (tag, site); its partition count is the
session's ``spark.sql.shuffle.partitions`` at the first run of a checkpoint
and is fixed afterwards, so size that setting for the full tag population
(e.g. with ``session.size_for_input``) before the first run on a cluster.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fishladder.operators.history import normalize_report

REPORT_SCHEMA = "Tag string, Site string, `Obs Time` string"
KEYS = ["pit_id", "site", "sitecode"]


def updates(det: DataFrame) -> DataFrame:
    """First detection per key, of a batch or of a stream."""
    return (det.where(F.col("obs_datetime").isNotNull())
               .groupBy(*KEYS).agg(F.min("obs_datetime").alias("obs_datetime")))


def fold(log: DataFrame) -> DataFrame:
    """First detection per key over any number of batches."""
    return log.groupBy(*KEYS).agg(F.min("obs_datetime").alias("obs_datetime"))


def _batch_writer(out_dir: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
        (batch.withColumns({"stream": F.lit(stream), "batch_id": F.lit(batch_id)})
              .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("stream", "batch_id").parquet(out_dir))
    return write


def checkpoint_of(landing_dir: str, out_dir: str) -> str:
    """The checkpoint of a landing folder (Spark ignores ``_`` names when it reads the log)."""
    return f"{out_dir.rstrip('/')}/_checkpoint/{hashlib.sha256(landing_dir.rstrip('/').encode()).hexdigest()[:32]}"


def run_stream(det_stream: DataFrame, out_dir: str, checkpoint: str):
    """Run the first-detection aggregation over everything available, then stop."""
    q = (updates(det_stream).writeStream.outputMode("update")
         .foreachBatch(_batch_writer(out_dir))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def ingest_reports(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint: str | None = None,
                   line_sep: str = "\r\n") -> None:
    """Process newly landed UTF-16LE report files (CSV) in ``landing_dir``.

    ``out_dir`` is a shared folder. Files already read are not read again, and
    what was found in files that have been moved away since stays."""
    src = (spark.readStream.schema(REPORT_SCHEMA)
           .options(header=True, encoding="UTF-16LE", lineSep=line_sep).csv(landing_dir))
    run_stream(normalize_report(src), out_dir, checkpoint or checkpoint_of(landing_dir, out_dir))


def first_detections(spark: SparkSession, out_dir: str) -> DataFrame:
    """Current first detection per (tag, site) from the batch log."""
    return fold(spark.read.parquet(out_dir))


def _log_folders(spark: SparkSession, out_dir: str) -> list[str]:
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(out_dir)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return [b.getPath().toString() for s in fs.listStatus(root) if s.getPath().getName().startswith("stream=")
            for b in fs.listStatus(s.getPath()) if b.getPath().getName().startswith("batch_id=")]


def compact(spark: SparkSession, out_dir: str) -> None:
    """Replace the batches logged so far by one folded batch.

    The folded rows are written first and the old batches deleted after; if
    that is cut short both are there, and folding them again gives the same
    table. Run it while no batch is being written.
    """
    old = _log_folders(spark, out_dir)
    if not old:
        return
    folded = first_detections(spark, out_dir).withColumns(
        {"stream": F.lit(f"compacted-{uuid.uuid4().hex}"), "batch_id": F.lit(0)})
    folded.write.mode("append").partitionBy("stream", "batch_id").parquet(out_dir)
    fs = spark._jvm.org.apache.hadoop.fs.Path(out_dir).getFileSystem(spark._jsc.hadoopConfiguration())
    for path in old:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)


def stream_parquet_reports(spark: SparkSession, directory: str, file_glob: str, to_report, out_dir: str) -> DataFrame:
    """Stream the Parquet files matching ``file_glob`` in ``directory``
    through ``to_report`` (source rows -> report rows: pit_id, obs_datetime,
    site, sitecode) into ``out_dir`` and return the first-detection table."""
    schema = spark.read.parquet(f"{directory.rstrip('/')}/{file_glob}").schema
    src = spark.readStream.schema(schema).option("pathGlobFilter", file_glob).parquet(directory)
    run_stream(to_report(src), out_dir, checkpoint_of(directory, out_dir))
    return first_detections(spark, out_dir)
