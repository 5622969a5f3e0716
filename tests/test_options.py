
import datetime as dt

from pyspark.sql import functions as F

from fishladder.operators import history as H
from fishladder.operators import window_counts as WC
from fishladder.plans import dashboard as B
from fishladder.sources import lookups as L
from tests.conftest import rows

T = dt.datetime
D = dt.date


def _marks(spark):
    return spark.createDataFrame(
        [("A", "DWOR", D(2025, 1, 1), "DWORMS x", "DWORMS", D(2025, 4, 1), "Juvenile", "Chinook", 1.0, "f"),
         ("B", "DWOR", D(2025, 1, 1), "DWORMS x", "DWORMS", D(2025, 4, 1), "Juvenile", "Chinook", 1.0, "f")],
        "pit_id string, hatchery string, mark_date date, release_site string, release_sitecode string, "
        "release_date date, mark_lifestage string, species string, length_mm double, tag_file string")


def test_upstream_before_release_option(spark):
    marks = _marks(spark)
    up = spark.createDataFrame([("A", T(2025, 3, 30)), ("B", T(2025, 4, 20))], "pit_id string, obs_datetime timestamp")
    assert H.exclude_upstream(marks, marks, up).count() == 0                       # presence only (Q31)
    kept = H.exclude_upstream(marks, marks, up, before_release=True)
    assert rows(kept, "pit_id") == [("B",)]


def test_year_guard_option(spark):
    marks = _marks(spark)
    rep = spark.createDataFrame([("A", T(2024, 5, 1), "GRJ", "GRJ"), ("B", T(2025, 5, 1), "GRJ", "GRJ")],
                                "pit_id string, obs_datetime timestamp, site string, sitecode string")
    none = spark.createDataFrame([], "pit_id string")
    dk = L.dam_key_df(spark, L.DAM_KEY_INSEASON)
    free = {r["pit_id"]: r["LGR"] for r in H.inseason_travel(marks, H.first_per_site(rep), dk, none).collect()}
    guard = {r["pit_id"]: r["LGR"] for r in
             H.inseason_travel(marks, H.first_per_site(rep), dk, none, year_guard=True).collect()}
    assert free["A"] == T(2024, 5, 1) and guard["A"] is None and guard["B"] == T(2025, 5, 1)


def test_window_dedupe_and_check(spark):
    cols = WC.WINDOW_COLUMNS
    row = ("Lower Granite", D(2024, 9, 1), 2024, None, 10.0, "Steelhead", 3.0, "All", "All", D(2024, 7, 1),
           D(1976, 9, 1), 2025, 3.0, 3.0)
    schema = ("dam string, date date, year int, run_type string, temp double, species string, count double, "
              "life_stage string, origin string, july_first date, dummy_date date, spawn_year int, "
              "running_total double, annual_total double")
    cur = spark.createDataFrame([row], schema)
    fin = spark.createDataFrame([row[:6] + (2.0,) + row[7:]], schema)
    assert WC.window_table(cur, fin).count() == 2                               # UNION ALL (Q12)
    assert WC.window_duplicates(WC.window_table(cur, fin)).count() == 1
    d = WC.window_table(cur, fin, dedupe=True).collect()
    assert len(d) == 1 and d[0]["count"] == 3.0 and list(d[0].asDict()) == cols


def test_last_week_modes(spark):
    sel = spark.createDataFrame(
        [("DWOR", 2026, "Steelhead", D(1976, 7, 1), 2), ("DWOR", 2026, "Steelhead", D(1976, 7, 8), 5)],
        "hatchery string, spawn_year int, species string, dummy_date date, daily_total long")
    as_of = D(2025, 7, 9)   # Steelhead spawn year 2026 in progress
    doy = rows(B.adult_last_week(sel, "Steelhead", as_of, ["DWOR"]))
    date = rows(B.adult_last_week(sel, "Steelhead", as_of, ["DWOR"], mode="date"))
    # as-of 9 Jul 2025 (day 190) and 2 Jul (183) map to 1976-07-08 and 1976-07-01 on the calendar
    assert date == [("DWOR", 7)]
    # day-of-year mode compares leap-year days of the 1976 dummy dates (183, 190) with 183..190
    assert doy == [("DWOR", 7)]
    assert rows(B.adult_last_week(sel.withColumn("dummy_date", F.lit(D(1976, 6, 30))), "Steelhead", as_of,
                                  ["DWOR"], mode="date")) == []
