import datetime as dt

from pyspark.sql import functions as F

from fishladder.operators import window_counts as WC
from fishladder.sources import lookups as L
from tests.conftest import rows

D = dt.date


def _report(spark, data):
    cols = [c for c, _ in L.WINDOW_COLUMNS_CURRENT]
    schema = "Project string, Date date, `Chinook Run` string, TempC double, " + \
        ", ".join(f"{c} double" for c in cols)
    full = []
    for proj, d, run, vals in data:
        full.append((proj, d, run, 10.0) + tuple(vals.get(c) for c in cols))
    return spark.createDataFrame(full, schema)


def test_window_classification(spark):
    rep = _report(spark, [("Lower Granite", D(2024, 5, 1), "Sp", {"Chin": 5.0, "JChin": 2.0, "WStlhd": 1.0, "JCoho": 3.0}),
                          ("Lower Granite", D(2024, 1, 2), None, {"Chin": 1.0})])
    long = WC.window_long(rep)
    assert long.count() == 2 * len(L.WINDOW_COLUMNS_CURRENT)  # rows x columns, NULL counts kept
    got = rows(long.where(F.col("count").isNotNull()), "date", "species", "life_stage", "origin", "count")
    assert got == [(D(2024, 1, 2), None, "Adult", "All", 1.0),
                   (D(2024, 5, 1), "Coho", "Jack", "All", 3.0),
                   (D(2024, 5, 1), "Spring Chinook", "Adult", "All", 5.0),
                   (D(2024, 5, 1), "Spring Chinook", "Jack", "All", 2.0),
                   (D(2024, 5, 1), "Steelhead", "All", "Wild", 1.0)]


def test_window_running_with_null_count(spark):
    rep = _report(spark, [("Bonneville", D(2024, 3, d), "Sp", {"Stlhd": v}) for d, v in ((1, 5.0), (2, None), (3, 2.0))])
    daily = WC.window_daily(rep).where((F.col("species") == "Steelhead") & (F.col("origin") == "All"))
    assert rows(daily, "date", "count", "running_total", "annual_total") == [
        (D(2024, 3, 1), 5.0, 5.0, 7.0), (D(2024, 3, 2), 0.0, 5.0, 7.0), (D(2024, 3, 3), 2.0, 7.0, 7.0)]


def test_finished_filter(spark):
    df = spark.createDataFrame([("Coho", D(2025, 9, 1)), ("Coho", D(2026, 2, 1)), ("Steelhead", D(2026, 2, 1)),
                                ("Steelhead", D(2026, 7, 2))], "species string, date date") \
        .withColumn("july_first", F.make_date(F.year("date"), F.lit(7), F.lit(1)))
    got = rows(WC.window_finished(df, D(2026, 3, 1)), "species", "date")
    assert got == [("Coho", D(2025, 9, 1)), ("Steelhead", D(2026, 2, 1))]


def test_dashboard_filter(spark):
    df = spark.createDataFrame([(None, "All", "Adult"), ("Steelhead", "Wild", "All"), ("Coho", "All", "Jack"),
                                ("Steelhead", "All", "All")], "species string, origin string, life_stage string")
    assert rows(WC.dashboard_window(df)) == [(None, "All", "Adult"), ("Steelhead", "All", "All")]  # N4


def test_current_season_join(spark):
    df = spark.createDataFrame([("Steelhead", 2026), ("Steelhead", 2025), ("Spring Chinook", 2025),
                                (None, 2025)], "species string, spawn_year int")
    got = rows(WC.window_current(df, D(2025, 7, 15)))
    assert got == [("Spring Chinook", 2025), ("Steelhead", 2026)]
