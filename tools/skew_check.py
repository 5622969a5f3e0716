"""Skew check: one tag holds a third of all detections.

usage: python tools/skew_check.py [sf_dir]
Runs the detection reductions on a skewed copy of the detections (built on
the fly from the driver tables: every third order key is mapped to one tag)
and reports, from Spark's event log, rows read, rows shuffled and the largest
number of shuffled rows one reduce task received.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def stage_metrics(log_dir: str) -> dict:
    import zstandard
    out = {}
    for f in glob.glob(f"{log_dir}/*/events*") + glob.glob(f"{log_dir}/*.zstd") + glob.glob(f"{log_dir}/app*"):
        raw = open(f, "rb").read()
        text = (zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read().decode()
                if f.endswith(".zstd") else raw.decode())
        for line in text.splitlines():
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                group = e.get("Properties", {}).get("spark.jobGroup.id")
                for sid in e["Stage IDs"]:
                    out.setdefault(sid, {"group": group, "read": 0, "shuffle_write": 0, "max_task_shuffle_read": 0})
            elif e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                m = out.setdefault(e["Stage ID"], {"group": None, "read": 0, "shuffle_write": 0,
                                                   "max_task_shuffle_read": 0})
                tm = e["Task Metrics"]
                m["read"] += tm["Input Metrics"]["Records Read"]
                m["shuffle_write"] += tm["Shuffle Write Metrics"]["Shuffle Records Written"]
                sr = tm["Shuffle Read Metrics"]
                got = sr["Total Records Read"] if "Total Records Read" in sr else sr.get("Records Read", 0)
                m["max_task_shuffle_read"] = max(m["max_task_shuffle_read"], got)
    return out


def _juvenile_history_snapshot(spark, sf, work_dir):
    """Capture histories written once (as the refresh job does), so the
    summary reads a table, not the whole upstream plan."""
    from fishladder.plans.queries import REGISTRY
    path = f"{work_dir}/juv_history"
    REGISTRY["juvenile_history"](spark, sf).write.mode("overwrite").parquet(path)
    return path


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-skew-", dir="/tmp")
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from fishladder.operators import history as H
    from fishladder.operators import passage as P
    from fishladder.operators import summaries as S
    from fishladder.sources import driver as D
    from fishladder.sources import lookups as L
    from fishladder.session import build_session
    spark = build_session("local[8]", shuffle_partitions=16,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 # keep the 16 hash partitions visible: a hot key would show up
                                 # as one oversized reduce task
                                 "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    plain = D.detections(spark, sf)
    skewed = plain.withColumn("pit_id", F.when(F.col("pit_id") % 3 == 0, F.lit(-1)).otherwise(F.col("pit_id")))
    total = plain.count()
    hot = skewed.where(F.col("pit_id") == -1).count()

    def jobs(det):
        return {
            "wide first detections per (tag, year)":
                H.wide_first_detections(H.attach_dams(det, D.dam_key(spark), "obs_sitecode"),
                                        keys=("pit_id", "obs_year")),
            "first per (tag, day, site)": H.first_per_site_day(det),
            "last per (dam, tag, year[, site]) + marks join, all dams": P.passage_tables_reduced(
                det, D.marks_table(spark, sf), D.PASSAGE_SITES, L.PASSAGE_PER_SITE, lambda df: df,
                obs_types=L.ADULT_OBS_TYPES),
        }

    # a hot *group*: one release group holds a third of all tags (exact medians)
    hist = spark.read.parquet(_juvenile_history_snapshot(spark, sf, log_dir))
    hist_hot = hist.withColumn("release_group", F.when(F.col("pit_id") % 3 == 0, F.lit("HOT"))
                               .otherwise(F.col("release_group")))
    summary_name = "emigration summary (exact medians), hot release group"

    names = list(jobs(plain)) + [summary_name]
    for label, det, h in (("plain", plain, hist), ("skewed", skewed, hist_hot)):
        todo = dict(jobs(det))
        todo[summary_name] = S.emigration_summary(h)
        for name, df in todo.items():
            spark.sparkContext.setJobGroup(f"{label}|{name}", name)
            df.write.format("noop").mode("overwrite").save()
    spark.stop()
    stats = stage_metrics(log_dir)

    def summary(group):
        st = [m for m in stats.values() if m["group"] == group]
        shuffled = max((m["shuffle_write"] for m in st if m["read"] > 0), default=0)
        biggest = max((m["max_task_shuffle_read"] for m in st), default=0)
        return shuffled, biggest

    print(f"detections: {total:,} rows; skewed copy: one tag holds {hot:,} rows ({hot / total:.0%})\n")
    print("| job | rows shuffled from the scan, plain → skewed | largest reduce task (rows, 16 partitions), plain → skewed |")
    print("| --- | --- | --- |")
    for name in names:
        p_s, p_b = summary(f"plain|{name}")
        s_s, s_b = summary(f"skewed|{name}")
        print(f"| {name} | {p_s:,} → {s_s:,} | {p_b:,} → {s_b:,} |")

if __name__ == "__main__":
    main()
