"""Shards by longest-processing-time scheduling.

Groups of equal texts must stay together; sorted by size, each goes to the
least-loaded shard through a heap. A corpus has too many groups for one heap,
but few sizes: groups of one size are interchangeable, so the driver schedules
size classes (size, number of groups), largest first. ``deal`` gives a class
out as the heap would, group by group: in closed form up to the level that the
heap reaches, the last few through the heap itself. Distinct sizes add up to
at most all bytes, so there are at most sqrt(2 x bytes) classes, whatever the
number of groups. Every group is scheduled this way; the loads are those of a
plain heap over all groups. Law: ``bytes`` (sizes near equal).

Which groups of a class a shard takes follows from their rank by text hash:
the first shard takes the first ranks, and so on. Ranks come from counts of
hash buckets, so a class of very many groups does not meet one task.

Slots number the rows of a shard without a gap. Rows of a shard fall into
buckets by a hash of the row; the counts of the buckets give each its first
slot, and rows are ordered inside a bucket only. Equal rows are counted before
they are numbered, so repeated rows cannot fill one task.

Defined cases: null text has no bytes and shares the group of the empty text;
a null id is an id like any other; repeated rows get a slot each; an empty
table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections import defaultdict
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fishladder.llm.common import documents, join_counted, work_dir, write_table

BUCKET_ROWS = 20_000
RUN = 1 << 16


def deal(loads: list[int], size: int, n: int) -> list[int]:
    """How many of ``n`` items of one size each shard gets from a heap; adds them to ``loads``."""
    # The heap gives out the n smallest of load + j * size. `level` is the n-th of them.
    upto = lambda level: [max(0, (level - x) // size + 1) for x in loads]
    low, high = min(loads), min(loads) + (n - 1) * size
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if sum(upto(mid)) >= n else (mid + 1, high)
    counts = upto(low - 1)                             # all items below the level
    heap = [(x + c * size, s) for s, (x, c) in enumerate(zip(loads, counts))]
    heapq.heapify(heap)
    for _ in range(n - sum(counts)):                   # those at the level, at most one a shard
        load, s = heapq.heappop(heap)
        counts[s] += 1
        heapq.heappush(heap, (load + size, s))
    loads[:] = [x + c * size for x, c in zip(loads, counts)]
    return counts


def schedule_classes(classes, shards: int):
    """(size, ends) per class of (size, number of groups), largest size first:
    shard s takes the ranks from ``ends[s - 1]`` up to, not including, ``ends[s]``."""
    loads = [0] * shards
    for size, n in sorted(classes, reverse=True):
        yield size, list(accumulate(deal(loads, size, n)))


def schedule(sizes: list[tuple], shards: int) -> dict:
    """{item: shard} by longest processing time, for a list of (item, size)."""
    items = defaultdict(list)
    for item, size in sorted(sizes):
        items[size].append(item)
    plan = schedule_classes([(size, len(x)) for size, x in items.items()], shards)
    return {item: bisect_right(ends, rank) for size, ends in plan for rank, item in enumerate(items[size])}


def _group_shards(groups: DataFrame, shards: int) -> DataFrame:
    """grp, n, shard for groups of (grp, bytes, n)."""
    spark = groups.sparkSession
    classes = write_table(groups.groupBy("bytes").agg(F.count(F.lit(1)).alias("groups")), work_dir(spark, "shard-classes"))
    plan = list(schedule_classes([(r.bytes, r.groups) for r in classes.collect()], shards))    # at most sqrt(2 x bytes) rows
    plan = write_table(spark.createDataFrame(plan, "bytes long, ends array<long>"), work_dir(spark, "shard-plan"))

    # a group's rank in its class: groups of earlier buckets, then the order in its bucket
    buckets = F.ceil(F.col("groups") / BUCKET_ROWS)
    sized = groups.join(classes, "bytes").select("grp", "n", "bytes", F.pmod("grp", buckets).alias("bucket"))
    counts = sized.groupBy("bytes", "bucket").agg(F.count(F.lit(1)).alias("in_bucket"))
    before = Window.partitionBy("bytes").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("bytes", "bucket", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("first"))
    order = Window.partitionBy("bytes", "bucket").orderBy("grp")
    ranked = (sized.withColumn("in_order", F.row_number().over(order) - 1).join(counts, ["bytes", "bucket"])
              .select("grp", "n", "bytes", (F.col("first") + F.col("in_order")).alias("rank")))
    shard = F.size(F.filter("ends", lambda end: end <= F.col("rank")))
    return write_table(ranked.join(plan, "bytes").select("grp", "n", shard.cast("int").alias("shard")), work_dir(spark, "group-shards"))


def assign_shards(df: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row."""
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    facts = write_table(df.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("grp")), work_dir(spark, "shard-facts"))

    groups = facts.groupBy("grp").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    groups = write_table(groups, work_dir(spark, "shard-groups"))
    rows = facts.count()
    parts = max(1, -(-rows // (BUCKET_ROWS * shards)))
    placed = (join_counted(facts, _group_shards(groups, shards), "grp", rows)
              .groupBy("shard", F.pmod(F.xxhash64("doc_id", "grp"), F.lit(parts)).alias("part"),
                       "doc_id", "size", "text_crc32", "grp").agg(F.count(F.lit(1)).alias("n")))
    placed = write_table(placed, work_dir(spark, "shard-rows"))

    firsts = placed.groupBy("shard", "part").agg(F.sum("n").alias("in_part"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.select("shard", "part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("first"))
    earlier = (Window.partitionBy("shard", "part").orderBy("doc_id", "grp", "text_crc32")
               .rowsBetween(Window.unboundedPreceding, -1))
    rows_ = (placed.withColumn("in_order", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
             .join(firsts, ["shard", "part"])
             # repeated rows: runs of at most RUN slots, then single slots
             .withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RUN).cast("long"))))
             .withColumn("k", F.explode(F.sequence("run", F.least(F.col("run") + (RUN - 1), F.col("n") - 1)))))
    return rows_.select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("in_order") + F.col("k")).alias("slot"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = assign_shards(documents(spark, sf_dir), 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
