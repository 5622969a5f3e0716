"""FIXTURES.md rows for dashboard panels and the emigration summary."""

import datetime as dt

from pyspark.sql import functions as F

from fishladder.operators.summaries import emigration_summary
from fishladder.plans import dashboard as B
from fishladder.sources import lookups as L
from tests.conftest import rows

D = dt.date
T = dt.datetime


def test_plot_limits_open_interval(spark):
    sel = spark.createDataFrame(
        [("Lower Granite", "Coho", 2024, D(2024, 9, 1), D(1976, 9, 1), 1.0),     # equal to min -> dropped
         ("Lower Granite", "Coho", 2024, D(2024, 9, 2), D(1976, 9, 2), 2.0),     # inside -> kept
         ("Lower Granite", "Coho", 2024, D(2024, 12, 31), D(1976, 12, 31), 3.0),  # equal to max -> dropped
         ("Lower Granite", "Chum", 2024, D(2024, 9, 2), D(1976, 9, 2), 4.0)],    # no limits row -> dropped
        "dam string, species string, spawn_year int, date date, dummy_date date, count double")
    out = B.window_daily_series(sel, L.window_plot_limits_df(spark))
    assert rows(out, "species", "count") == [("Coho", 2.0)]


def test_comparison_keeps_null_group(spark):
    s = spark.createDataFrame([(2024, "Chinook", None), (2024, "Chinook", "Powell"), (2024, "Chinook", "Kooskia"),
                               (2010, "Chinook", None)], "release_year int, species string, release_group string")
    got = rows(B.emigration_comparison(s, "Chinook", (2020, 2025)), "release_group")
    assert got == [("Kooskia",), (None,)]


def test_summary_fixture(spark):
    hist = spark.createDataFrame(
        [("DWOR", "Chinook", 2024, "A", D(2024, 4, 1), 3, T(2024, 4, 4), None, None),
         ("DWOR", "Chinook", 2024, "A", D(2024, 4, 5), 4, T(2024, 4, 9), None, None),
         ("DWOR", "Chinook", 2024, "N", D(2024, 4, 1), None, None, None, None)],
        "hatchery string, species string, release_year int, release_group string, release_date date, "
        "lgr_traveltime long, LGR timestamp, bonn_traveltime long, BONN timestamp")
    got = {r["release_group"]: r for r in emigration_summary(hist).collect()}
    a, n = got["A"], got["N"]
    assert a["median_lgr"] == 3 and a["lgr_detections"] == 2 and a["median_lgr_date"] == D(2024, 4, 6)
    assert a["earliest_release"] == "April 01" and a["latest_release"] == "April 05"
    assert n["median_lgr"] is None and n["lgr_detections"] == 0 and n["median_bonn_date"] is None


def test_window_ytd_and_labels(spark):
    sel = spark.createDataFrame([("Bonneville", D(2024, 6, 1), 1200.0), ("Bonneville", D(2024, 6, 2), 12345.0)],
                                "dam string, date date, running_total double")
    r = B.window_ytd(sel).collect()[0]
    assert r["date"] == D(2024, 6, 2) and r["label"] == "Bonneville: 12,345"
    cmp = spark.createDataFrame([("DWOR", 2024, "A", 30, None, "April 01", "April 05")],
                                "hatchery string, release_year int, release_group string, median_lgr long, "
                                "median_bonn long, earliest_release string, latest_release string")
    lab = B.comparison_series(cmp).collect()[0]
    assert lab["lgr_label"] == " Release Year: 2024 <br> Release Dates: April 01 - April 05 <br> " \
                               "Median Travel Time to LGR: 30 days"
    assert lab["bonn_label"] is None  # a NULL part makes the whole text NULL (N8)


def test_tag_count_and_axis(spark):
    juv = spark.createDataFrame(
        [("Chinook", "DWOR", T(2025, 3, 27), T(2025, 4, 20)), ("Chinook", "KOOS", T(2025, 4, 1), None)],
        "species string, hatchery string, release_date timestamp, LGR timestamp")
    tc = B.tag_count(juv, "DWOR").collect()[0]
    assert (tc["selected_species"], tc["tag_count"], tc["tag_label"]) == ("Chinook", 1, "Number Tagged: 1")
    juv = juv.withColumn("release_group", F.lit("g"))
    counted = B.arrivals(juv, "Chinook", "LGR", F.col("hatchery") == "DWOR")
    ax = B.axis_limits(counted).collect()[0]
    assert ax["xmin"] == T(2025, 3, 25) and ax["xmax"] == T(2025, 4, 27)


def test_control_limits_defaults(spark):
    a = spark.createDataFrame([(2023,), (2025,)], "spawn_year int")
    w = spark.createDataFrame([(2010,), (2026,)], "spawn_year int")
    s = spark.createDataFrame([(2020,), (2025,)], "release_year int")
    g = spark.createDataFrame([("Selway",), ("Lochsa",), ("Selway",)], "name string")
    r = B.control_limits(a, w, s, g, D(2025, 5, 1)).collect()[0]
    assert (r["adult_min_sy"], r["adult_max_sy"], r["window_max_sy"], r["window_default_sy"]) == (2023, 2025, 2025, 2016)
    assert (r["release_default_from"], r["gauge_sites"], r["default_adult_species"]) == (2020, "Lochsa, Selway", "Chinook")
    assert B.control_limits(a, w, s, g, D(2025, 8, 1)).collect()[0]["default_adult_species"] == "Steelhead"
