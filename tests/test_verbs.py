import datetime as dt

from pyspark.sql import functions as F

from fishladder.operators.verbs import (carry_forward, densify_dates, filter_not_in, first_by, last_by,
                                        running_totals, union_all)
from tests.conftest import rows

T = dt.datetime


def test_first_by_drops_all_null_group(spark):
    df = spark.createDataFrame([("A", "GRJ", T(2025, 4, 1, 10)), ("A", "GRJ", T(2025, 4, 1, 9)),
                                ("A", "GRJ", None), ("B", "GRJ", None)], "pit_id string, site string, t timestamp")
    out = first_by(df, ["pit_id", "site"], ["t"], [])
    assert rows(out) == [("A", "GRJ", T(2025, 4, 1, 9))]  # N1: no row for B


def test_first_by_tie_is_stable_under_shuffling(spark):
    data = [("A", T(2025, 4, 1, 9), "x"), ("A", T(2025, 4, 1, 9), "a"), ("A", T(2025, 4, 1, 11), "0")]
    picks = set()
    for n in (1, 3, 7):
        df = spark.createDataFrame(data, "pit_id string, t timestamp, v string").repartition(n)
        picks.add(tuple(first_by(df, ["pit_id"], ["t"], ["v"]).collect()[0]))
    assert picks == {("A", T(2025, 4, 1, 9), "a")}


def test_last_by(spark):
    df = spark.createDataFrame([("A", 2025, T(2025, 9, 1, 8), "BO1"), ("A", 2025, T(2025, 9, 1, 10), "BO1"),
                                ("A", 2025, T(2025, 9, 1, 9), "BO2")], "pit_id string, y int, t timestamp, s string")
    assert rows(last_by(df, ["pit_id", "y"], ["t"], ["s"])) == [("A", 2025, T(2025, 9, 1, 10), "BO1")]
    assert rows(last_by(df, ["pit_id", "y", "s"], ["t"], [])) == [
        ("A", 2025, "BO1", T(2025, 9, 1, 10)), ("A", 2025, "BO2", T(2025, 9, 1, 9))]


def test_running_totals_row_frame(spark):
    df = spark.createDataFrame([("g", 1, 2), ("g", 2, 1), ("g", 4, 3)], "k string, d int, n long")
    out = running_totals(df, ["k"], ["d"], "n")
    assert rows(out, "d", "running_total", "annual_total") == [(1, 2, 6), (2, 3, 6), (4, 6, 6)]


def test_running_totals_null_counts(spark):
    df = spark.createDataFrame([("g", 1, 5.0), ("g", 2, None), ("g", 3, 2.0)], "k string, d int, n double")
    out = running_totals(df, ["k"], ["d"], "n", fill_null=True)
    assert rows(out, "d", "n", "running_total") == [(1, 5.0, 5.0), (2, 0.0, 5.0), (3, 2.0, 7.0)]


def _daily(spark, days, limit):
    base = dt.date(1976, 1, 1)
    return spark.createDataFrame(
        [("Chinook", "H", 2025, "LGR", base + dt.timedelta(days=d - 1), n, r, tot, base + dt.timedelta(days=limit - 1))
         for d, n, r, tot in days],
        "species string, hatchery string, spawn_year int, dam string, dummy_date date, daily_total long, "
        "running_total long, annual_total long, lim date")


def test_densify_keeps_rows_outside_range(spark):
    df = _daily(spark, [(1, 2, 2, 7), (3, 1, 3, 7), (9, 4, 7, 7)], limit=5)
    keys = ["species", "hatchery", "spawn_year", "dam"]
    dense = densify_dates(df, keys, "dummy_date", "lim").drop("lim")
    dense = dense.withColumn("daily_total", F.coalesce("daily_total", F.lit(0).cast("long")))
    dense = carry_forward(dense, keys, ["dummy_date"], ["running_total", "annual_total"])
    got = rows(dense, "dummy_date", "daily_total", "running_total")
    d = lambda i: dt.date(1976, 1, i)
    assert got == [(d(1), 2, 2), (d(2), 0, 2), (d(3), 1, 3), (d(4), 0, 3), (d(5), 0, 3), (d(9), 4, 7)]


def test_densify_limit_before_min_leaves_rows(spark):
    df = _daily(spark, [(7, 1, 1, 2), (8, 1, 2, 2)], limit=5)
    dense = densify_dates(df, ["species", "hatchery", "spawn_year", "dam"], "dummy_date", "lim")
    assert dense.count() == 2  # N13


def test_union_all_and_not_in(spark):
    a = spark.createDataFrame([("x", 1)], "g string, a int")
    b = spark.createDataFrame([(None, 2.0)], "g string, b double")
    u = union_all(a, b)
    assert set(u.columns) == {"g", "a", "b"} and u.count() == 2
    kept = u.where(filter_not_in("g", ["x"]))
    assert kept.count() == 1 and kept.collect()[0]["g"] is None  # N2
