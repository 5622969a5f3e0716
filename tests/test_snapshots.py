"""Versions of hand-off tables: compare-and-set commits, partition-level
versions, bucketed tables."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from fishladder.sources import sinks
from fishladder.sources.readers import read_snapshot
from fishladder.sources.sinks import ConflictError, current_number, manifest, update_partitions, write_snapshot


def table(spark, years, value=0, rows=50):
    df = spark.range(rows * len(years)).select(F.col("id"), F.lit(value).alias("v"), F.array(*[F.lit(y) for y in years]).alias("ys"))
    return df.select("id", "v", F.element_at("ys", (F.col("id") % len(years) + 1).cast("int")).alias("year"))


def totals(spark, path):
    return {r["year"]: (r["n"], r["s"]) for r in read_snapshot(spark, path).groupBy("year").agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")).collect()}


def test_a_writer_with_an_old_view_is_refused(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    write_snapshot(spark.range(3), path)
    seen = current_number(spark, path)
    write_snapshot(spark.range(4), path, expect=seen)
    with pytest.raises(ConflictError):
        write_snapshot(spark.range(5), path, expect=seen)
    assert read_snapshot(spark, path).count() == 4
    write_snapshot(spark.range(6), path, expect=current_number(spark, path))
    assert read_snapshot(spark, path).count() == 6


def test_two_writers_at_once_never_share_a_number(spark, tmpdir_path):
    path, done = f"{tmpdir_path}/t", []
    write_snapshot(spark.range(1), path)
    seen = current_number(spark, path)

    def write(n):
        try:
            write_snapshot(spark.range(n), path, expect=seen)
            done.append(("won", n))
        except ConflictError:
            done.append(("refused", n))
    threads = [threading.Thread(target=write, args=(n,)) for n in (10, 20, 30)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    won = [n for what, n in done if what == "won"]
    assert len(done) == 3 and len(won) == 1
    assert read_snapshot(spark, path).count() == won[0]
    numbers = [n for n, _ in sinks._pointers(spark, path)]
    assert numbers == sorted(set(numbers)) and not os.path.exists(f"{path}/_pointers/{sinks.LOCK}")


def test_updates_of_different_partitions_both_count(spark, tmpdir_path, monkeypatch):
    path = f"{tmpdir_path}/t"
    write_snapshot(table(spark, [2020, 2021, 2022]), path, "year")
    before = sinks._write
    other = []

    def meanwhile(df, folder, *args):
        before(df, folder, *args)
        if not other:                                   # another writer switches between this one's write and its commit
            other.append(1)
            update_partitions(table(spark, [2022], 9), path, "year")
    monkeypatch.setattr(sinks, "_write", meanwhile)
    update_partitions(table(spark, [2021], 5), path, "year")
    assert totals(spark, path) == {2020: (50, 0), 2021: (50, 250), 2022: (50, 450)}
    other.clear()
    with pytest.raises(ConflictError):
        update_partitions(table(spark, [2022, 2020], 1), path, "year")      # the other one changes 2022, too
    assert totals(spark, path) == {2020: (50, 0), 2021: (50, 250), 2022: (50, 450)}


def test_only_changed_partitions_are_written(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    update_partitions(table(spark, [2020, 2021, None], 1), path, "year")
    assert totals(spark, path) == {2020: (50, 50), 2021: (50, 50), None: (50, 50)}
    new = table(spark, [2020, 2021, None], 1).withColumn("v", F.when(F.col("year") == 2021, 7).otherwise(F.col("v")))
    folder = update_partitions(new.repartition(7), path, "year", only_changed=True)
    written = [d for d in os.listdir(folder.removeprefix("file:")) if "=" in d]
    assert written == ["year=2021"] and totals(spark, path) == {2020: (50, 50), 2021: (50, 350), None: (50, 50)}
    held = manifest(spark, path)["parts"]
    assert len({p["version"] for p in held.values()}) == 2
    # nothing changed, and a partition gone
    folder = update_partitions(new.where("year = 2021 OR year IS NULL"), path, "year", only_changed=True, whole=True)
    assert not [d for d in os.listdir(folder.removeprefix("file:")) if "=" in d]
    assert totals(spark, path) == {2021: (50, 350), None: (50, 50)}
    # filters reach the partitions' folders
    plan = read_snapshot(spark, path).where("year = 2021")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_old_versions_go_when_no_kept_one_uses_them(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    update_partitions(table(spark, [1, 2]), path, "year")
    for v in range(1, 5):
        update_partitions(table(spark, [2], v), path, "year")
    assert totals(spark, path) == {1: (50, 0), 2: (50, 200)}
    folders = [d for d in os.listdir(path) if d.startswith("v-")]
    assert len(folders) == 3                              # year 1 of the first version, the last two of year 2


def test_a_dead_writers_lock_is_broken(spark, tmpdir_path, monkeypatch):
    path = f"{tmpdir_path}/t"
    write_snapshot(spark.range(1), path)
    open(f"{path}/_pointers/{sinks.LOCK}", "w").close()
    monkeypatch.setattr(sinks, "LOCK_WAIT_S", 0.3)
    with pytest.raises(RuntimeError):
        write_snapshot(spark.range(2), path)
    monkeypatch.setattr(sinks, "LOCK_STALE_S", 0.0)
    write_snapshot(spark.range(2), path)
    assert read_snapshot(spark, path).count() == 2


def test_bucketed_tables_join_without_a_shuffle(spark, tmpdir_path):
    a, b = f"{tmpdir_path}/a", f"{tmpdir_path}/b"
    write_snapshot(table(spark, [2020, 2021, None]), a, "year", bucket_by="id", buckets=4)
    write_snapshot(table(spark, [2020, 2021], 3), b, bucket_by="id", buckets=4)
    update_partitions(table(spark, [2021], 5).where("id < 20"), a, "year")          # keeps the buckets
    assert manifest(spark, a)["buckets"] == 4
    left, right = read_snapshot(spark, a), read_snapshot(spark, b)
    right = right.groupBy("id").agg(F.sum("v").alias("w"))
    j = left.join(right, "id", "left")
    assert "Exchange" not in j._jdf.queryExecution().executedPlan().toString()
    want = {(r["id"], r["v"], r["year"]) for r in left.collect()}
    assert {(r["id"], r["v"], r["year"]) for r in j.collect()} == want and len(want) == 50 + 50 + 20
    assert {r["w"] for r in j.where("id < 100").collect()} == {3}
