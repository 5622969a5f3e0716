"""Tag id export in fixed-size chunks for the bulk tag-history lookup.

Numbering rows needs a global order, but a window without PARTITION BY
would pull every id into one task. Ids are counted (equal ids combine
map-side), range-partitioned, and written to the shared folder together with
the number of their range. From then on the range is data, not a property of
a plan: the ranges' totals give each its first number, and ids are numbered
inside their range only.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fishladder.sources import lookups as L
from fishladder.sources.subtables import scratch_table

RUN = 1 << 16


def number_rows(df: DataFrame, order_col: str, name: str = "row_index") -> DataFrame:
    """(order_col, 0-based global row number) of every row, in the order of ``order_col``."""
    r = scratch_table(df.sparkSession, "numbered-rows",
                      df.groupBy(order_col).agg(F.count(F.lit(1)).alias("_n"))
                        .repartitionByRange(order_col).withColumn("_range", F.spark_partition_id()))
    # one row per range
    firsts = r.groupBy("_range").agg(F.sum("_n").alias("_rows"))
    firsts = firsts.select("_range", (F.sum("_rows").over(Window.orderBy("_range").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)) - F.col("_rows")).alias("_first"))
    before = Window.partitionBy("_range").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    out = r.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(F.broadcast(firsts), "_range")
    # repeated ids: runs of at most RUN numbers, then single numbers
    last = F.col("_n") - 1
    out = (out.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(RUN).cast("long"))))
              .withColumn("_k", F.explode(F.sequence("_run", F.least(F.col("_run") + (RUN - 1), last)))))
    return out.select(order_col, (F.col("_first") + F.col("_before") + F.col("_k")).alias(name))


def tag_chunks(marks: DataFrame, chunk: int = L.TAG_CHUNK_SIZE, id_col: str = "pit_id") -> DataFrame:
    """(chunk, pit_id) with chunk = floor(index / size) + 1 in id order."""
    n = number_rows(marks.select(id_col), id_col)
    return n.select((F.floor(F.col("row_index") / chunk) + 1).cast("int").alias("chunk"), id_col)


CHUNKS_PER_TASK = 64


def write_chunk_files(marks: DataFrame, out_dir: str, chunk: int = L.TAG_CHUNK_SIZE, id_col: str = "pit_id",
                      per_task: int = CHUNKS_PER_TASK) -> int:
    """The ids of every chunk as one plain text file ``<n>.txt``, all in
    the folder ``out_dir``; returns the number of chunks.

    A task gets the ids of ``per_task`` chunks in a row, in order, and Spark's
    text writer starts a new file after every ``chunk`` ids: file j of task p is
    chunk p * per_task + j + 1. Its commit protocol keeps one attempt of every
    task, so a retry leaves no chunk twice. The files are then renamed out of
    the staging folder; ``_SUCCESS`` comes last, and a later export replaces the
    files of an earlier one.
    """
    spark = marks.sparkSession
    rows = number_rows(marks.select(id_col), id_col)
    index = F.col("row_index")
    n = rows.count()
    tasks = max(1, -(-n // (chunk * per_task)))
    out, jvm = out_dir.rstrip("/"), spark._jvm
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = path(out).getFileSystem(spark._jsc.hadoopConfiguration())
    staged = f"{out}/_staged-{uuid.uuid4().hex}"
    (rows.repartitionById(tasks, F.floor(index / (chunk * per_task)).cast("int"))
         .sortWithinPartitions("row_index").select(F.col(id_col).cast("string").alias("value"))
         .write.option("maxRecordsPerFile", chunk).text(staged))

    fs.delete(path(f"{out}/_SUCCESS"), False)
    for st in fs.listStatus(path(out)):
        if st.isFile() and re.fullmatch(r"[0-9]+[.]txt", st.getPath().getName()):
            fs.delete(st.getPath(), False)
    done = 0
    files = fs.listFiles(path(staged), False)
    while files.hasNext():
        at = files.next().getPath()
        part = re.match(r"part-([0-9]+)-.*-c([0-9]+)[.]txt", at.getName())
        if part and n:            # no ids: the writer leaves one empty file
            if not fs.rename(at, path(f"{out}/{int(part[1]) * per_task + int(part[2]) + 1}.txt")):
                raise RuntimeError(f"could not rename {at}")
            done += 1
    if done != -(-n // chunk):
        raise RuntimeError(f"{done} chunk files for {n} ids of {chunk} each")
    fs.delete(path(staged), True)
    fs.createNewFile(path(f"{out}/_SUCCESS"))
    return done


def write_chunks(chunks: DataFrame, out_dir: str, id_col: str = "pit_id") -> None:
    """One text file set per chunk directory (``chunk=<n>/``), ids only."""
    (chunks.repartition("chunk").sortWithinPartitions(id_col)
           .select("chunk", F.col(id_col).cast("string").alias("value"))
           .write.mode("overwrite").partitionBy("chunk").text(out_dir))
