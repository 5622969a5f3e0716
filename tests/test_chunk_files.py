"""Tag ids as plain files in one folder; upstream exclusion without a shuffle
of the large sides."""

import os

import pytest
from pyspark.sql import functions as F
from test_skew import shuffled_rows

from fishladder.operators import history as H
from fishladder.operators.chunks import tag_chunks, write_chunk_files
from fishladder.sources import driver as Dv

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n, size, per_task", [(2503, 100, 4), (200, 100, 64), (1, 100, 64), (1200, 1, 7)])
def test_one_plain_file_per_chunk(spark, tmpdir_path, n, size, per_task):
    ids = spark.range(n).select(F.format_string("3D9.%08d", (F.col("id") * 7919) % 25013).alias("pit_id")).repartition(5)
    out = f"{tmpdir_path}/chunks"
    if n > 200:
        write_chunk_files(ids.limit(150), out, 1 if n == 2503 else size)             # an earlier export with other chunks
    assert write_chunk_files(ids, out, size, per_task=per_task) == -(-n // size)
    names = [f for f in os.listdir(out) if not f.startswith(".")]
    assert sorted(names) == sorted([f"{i}.txt" for i in range(1, -(-n // size) + 1)] + ["_SUCCESS"])
    want = {}
    for r in tag_chunks(ids, size).collect():
        want.setdefault(r["chunk"], []).append(r["pit_id"])
    for c, tags in want.items():
        assert open(f"{out}/{c}.txt").read().split() == sorted(tags)


def test_no_ids_make_no_files(spark, tmpdir_path):
    assert write_chunk_files(spark.range(0).select(F.col("id").cast("string").alias("pit_id")), f"{tmpdir_path}/none") == 0
    assert [f for f in os.listdir(f"{tmpdir_path}/none") if not f.startswith(".")] == ["_SUCCESS"]


@pytest.mark.parametrize("before", [False, True])
def test_upstream_exclusion_shuffles_no_marks(spark, tmpdir_path, before):
    marks = Dv.marks(spark, SF)
    twice = marks.unionByName(marks.limit(50))                              # some tags marked twice
    path = f"{tmpdir_path}/m"
    twice.write.parquet(path)
    twice = spark.read.parquet(path)
    up = Dv.detections(spark, SF).where("obs_sitecode = 'S6'").select("pit_id", "obs_datetime").unionByName(
        spark.createDataFrame([(None, None)], "pit_id long, obs_datetime timestamp"))
    codes = ["DWORNF", "KOOS"]
    small = H.exclude_upstream(twice, twice, up, codes, before_release=before)
    large = H.exclude_upstream(twice, twice, up, codes, before_release=before, broadcast_rows=0)
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(small) == key(large) and 0 < small.count() < twice.count()
    few, many = shuffled_rows(small), shuffled_rows(large)
    assert few < 0.2 * many, (few, many)
