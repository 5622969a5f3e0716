"""Sub-tables of a session: built once per input version, rebuilt when an input
changes or the folder is gone, removed at the end."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from fishladder.sources import subtables
from fishladder.sources.subtables import drop_subtables, input_version, scratch_table, subtable


@pytest.fixture()
def source(spark, tmpdir_path):
    path = f"{tmpdir_path}/in.parquet"
    spark.range(10).write.parquet(path)
    return path


def paths_of(spark, name):
    return [e[1] for (n, _), kept in subtables._TABLES[spark.sparkContext.applicationId].items() if n == name for e in kept]


def test_a_subtable_is_built_once_per_version(spark, source):
    built = []

    def table(params=()):
        def build():
            built.append(params)
            return spark.read.parquet(source).select((F.col("id") * 2).alias("v"))
        return subtable(spark, "twice", (source, *params), input_version(spark, source), build)
    assert table().agg(F.sum("v")).first()[0] == table().agg(F.sum("v")).first()[0] == 90
    assert built == [()]
    table((1,))
    assert built == [(), (1,)]
    spark.range(3).write.mode("append").parquet(source)                  # a new version of the input
    assert table().agg(F.sum("v")).first()[0] == 96
    assert len(built) == 3


def test_only_the_latest_versions_stay(spark, source):
    for i in range(4):
        df = subtable(spark, "kept", (source,), f"v{i}", lambda: spark.range(5))
    found = paths_of(spark, "kept")
    assert len(found) == subtables.KEEP and all(os.path.isdir(p.removeprefix("file:")) for p in found)
    assert df.count() == 5


def test_a_lost_folder_is_built_again(spark, source):
    make = lambda: subtable(spark, "lost", (source,), "v", lambda: spark.range(7))
    make()
    path = paths_of(spark, "lost")[0].removeprefix("file:")
    os.rename(path, path + "-away")
    assert make().count() == 7 and not os.path.exists(path)
    shutil.rmtree(path + "-away")


def test_input_version_sees_files(spark, source, tmpdir_path):
    one = input_version(spark, source)
    assert one == input_version(spark, [source]) != input_version(spark, f"{tmpdir_path}/nothing")
    spark.range(1).write.mode("append").parquet(source)
    assert input_version(spark, source) != one


def test_drop_removes_all_folders(spark):
    other = spark.sparkContext.applicationId
    before = dict(subtables._TABLES.pop(other, {}))                      # other tests' tables stay
    df = scratch_table(spark, "scratch", spark.range(4))
    path = df.inputFiles()[0].removeprefix("file://").removeprefix("file:").rsplit("/", 1)[0]
    assert df.count() == 4 and os.path.isdir(path)
    assert drop_subtables(spark) == 1 and not os.path.exists(path)
    assert drop_subtables(spark) == 0
    subtables._TABLES[other].update(before)
