"""What a task of the large queries holds, and what they build on the way."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fishladder.operators import history as H
from fishladder.operators import summaries as S
from fishladder.plans import dashboard as B
from fishladder.plans import queries as Q
from fishladder.session import MAX_PARTITIONS, TASK_INPUT, TASK_SCAN, TASK_SHUFFLE, bound_tasks
from fishladder.sources import driver as D
from fishladder.sources import subtables
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SIZES = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"]
T = dt.datetime


@pytest.fixture()
def conf(spark):
    keys = [INITIAL, *SIZES, "spark.sql.codegen.aggregate.map.twolevel.enabled"]
    before = {k: spark.conf.get(k, None) for k in keys}
    yield spark.conf
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture()
def no_tables(spark):
    """A session that has built no sub-table yet; the other tests' tables come back after."""
    app = spark.sparkContext.applicationId
    before = dict(subtables._TABLES.pop(app, {}))
    yield lambda: {name for (name, _), kept in subtables._TABLES[app].items() if kept}
    subtables.drop_subtables(spark)
    subtables._TABLES[app].update(before)


def test_partitions_grow_with_the_input(spark, conf):
    own = int(conf.get("spark.sql.shuffle.partitions"))
    assert bound_tasks(spark, 1000) == own
    assert bound_tasks(spark, 6 << 30) == (6 << 30) // TASK_INPUT + 1 == int(conf.get(INITIAL))
    assert bound_tasks(spark, 1 << 60) == MAX_PARTITIONS
    assert bound_tasks(spark, 1000) == own == int(conf.get(INITIAL))


def test_sizes_of_a_task_are_lowered_never_raised(spark, conf):
    conf.set(SIZES[0], "64m")
    conf.set(SIZES[1], "2m")
    bound_tasks(spark, 1000)
    assert conf.get(SIZES[0]) == f"{TASK_SHUFFLE}b" and conf.get(SIZES[1]) == "2m"
    conf.set(SIZES[1], "128MB")
    bound_tasks(spark, 1000)
    assert conf.get(SIZES[1]) == f"{TASK_SCAN}b"


def test_registered_queries_size_their_tasks(spark, conf, monkeypatch):
    monkeypatch.setattr(Q, "tables_bytes", lambda spark, sf: 10 * TASK_INPUT)
    n = Q.REGISTRY["first_per_site_stream"](spark, SF).count()
    assert int(conf.get(INITIAL)) == 11 and n > 0
    monkeypatch.undo()
    assert Q.tables_bytes(spark, SF) > 0 and Q.tables_bytes(spark, "/root/testdata/nothing") == 0


def test_timing_and_density_make_no_table_of_all_dams(spark, no_tables):
    got = {name: rows(Q.REGISTRY[name](spark, SF)) for name in ("timing_summary", "b04")}
    assert "arrivals_df" in no_tables() and "inseason_travel_df" not in no_tables()
    travel = Q.inseason_travel_df(spark, SF)                              # from now on the session has it
    assert "inseason_travel_df" in no_tables()
    whole = B.timing_summary(travel, "Chinook", "LGR", Q.own("Chinook"))
    assert got["timing_summary"] == rows(Q.naive_timestamps(whole))
    assert got["b04"] == rows(Q._rounded_density(B.arrival_density(travel, "Chinook", "BONN", Q.own("Chinook"))))
    assert Q.inseason_travel_at(spark, SF, ["LGR"]).columns == travel.columns


def test_emigration_makes_no_wide_tables(spark, no_tables):
    got = rows(Q.REGISTRY["emigration_all"](spark, SF))
    assert not {"inseason_travel_df", "marks_table_v"} & no_tables()
    assert {"history_counts", "inseason_counts"} <= no_tables()
    want = S.emigration_all(S.emigration_summary(Q.juvenile_history_df(spark, SF)),
                            S.emigration_summary(Q.inseason_travel_df(spark, SF)))
    assert got == rows(want, *Q.REGISTRY["emigration_all"](spark, SF).columns)


def test_travel_of_some_dams_equals_the_whole_table(spark):
    first = H.first_per_site(D.report(spark, SF))
    made = lambda levels: H.inseason_travel(
        D.marks(spark, SF), first, D.dam_key(spark), D.upstream_tags(spark, SF), levels=levels, release_dates=D.RELEASE_DATES)
    some, whole = made(["BONN"]), made(None)
    assert rows(some) == rows(whole, *some.columns)
    # other dams' sites are dropped below the first detections
    lines = some._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(lines) if "Aggregate" in line and "site#" in line)
    assert any("LeftSemi" in line and "sitecode" in line for line in lines[at:])


def test_observation_time_is_ship_date_plus_minutes(spark):
    li = spark.sql("SELECT * FROM VALUES (1L, 61L, 1, 'A', TIMESTAMP_NTZ '1999-12-31 23:30:00.000001'), "
                   "(2L, 300000L, 2, 'A', TIMESTAMP_NTZ '1969-01-01 00:00:00'), (3L, NULL, 2, 'A', TIMESTAMP_NTZ '1999-01-01 00:00:00'), "
                   "(4L, 5L, 2, 'A', NULL) AS t(l_orderkey, l_suppkey, l_linenumber, l_returnflag, l_shipdate)")
    got = {r["pit_id"]: r["t"] for r in D.report_rows(li).select("pit_id", F.col("obs_datetime").cast("timestamp_ntz").alias("t")).collect()}
    assert got == {1: T(2000, 1, 1, 0, 31, 0, 1), 2: T(1969, 7, 28, 8, 0), 3: None, 4: None}


def histories(spark):
    """Groups with many arrivals, one with none, one with an undated release, one without a name."""
    df = spark.range(400).select((F.col("id") % 4).alias("g"), F.col("id").alias("i"))
    at = F.when(F.col("g") != 1, F.timestamp_seconds(F.lit(900_000_000) + F.col("i") * 7919 * (F.col("i") % 37)))
    return df.select(F.when(F.col("g") < 3, F.concat(F.lit("H"), F.col("g").cast("string"))).alias("hatchery"),
                     F.lit("Chinook").alias("species"), F.lit(1998).alias("release_year"), F.lit("x").alias("release_group"),
                     at.alias("LGR"), F.when(F.col("i") % 3 == 0, at).alias("BONN"),
                     (F.col("i") % 200).alias("lgr_traveltime"), (F.col("i") % 90 - 45).alias("bonn_traveltime"),
                     F.when(F.col("i") != 2, F.lit("1998-04-05").cast("date")).alias("release_date"))


def test_counts_keep_missing_values_only_of_releases(spark):
    counts = S.summary_counts(histories(spark))
    assert counts.where(F.col("_v").isNull()).select("_m").distinct().collect() == [("_rel",)]
    assert counts.where("_m = '_rel'").agg(F.sum("_c")).first()[0] == 400


def test_summary_from_written_buckets(spark):
    hist = histories(spark)
    counts = S.summary_counts(hist)
    buckets = subtables.scratch_table(spark, "buckets", S.median_buckets(counts))
    want = hist.groupBy("hatchery").agg(
        F.floor(F.expr("median(lgr_traveltime)")).alias("median_lgr"), F.floor(F.expr("median(bonn_traveltime)")).alias("median_bonn"),
        F.to_date(F.timestamp_micros(F.expr("floor(median(unix_micros(LGR)))").cast("long"))).alias("median_lgr_date"),
        F.count("LGR").alias("lgr_detections"), F.count("BONN").alias("bonn_detections"))
    for made in (S.summary_of_counts(counts), S.summary_of_counts(counts, buckets=buckets),
                 S.summary_of_counts(counts, buckets=buckets, bucket_rows=0)):
        assert rows(made, *want.columns) == rows(want)
    near = S.summary_of_counts(counts, buckets=buckets)._jdf.queryExecution().optimizedPlan().toString()
    far = S.summary_of_counts(counts, buckets=buckets, bucket_rows=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in near and "strategy=broadcast" not in far
