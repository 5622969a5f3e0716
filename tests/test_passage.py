import datetime as dt

from fishladder.operators import passage as P
from fishladder.sources import lookups as L
from tests.conftest import rows

T = dt.datetime
D = dt.date


def _marks(spark, data):
    return spark.createDataFrame(data, "pit_id string, hatchery string, species string, release_date date, "
                                       "release_group string, mark_lifestage string")


def _det(spark, data):
    return spark.createDataFrame(data, "pit_id string, obs_datetime timestamp, obs_sitecode string")


def test_passage_lower_per_site_upper_per_year(spark):
    marks = _marks(spark, [("A", "DWOR", "Chinook", D(2022, 4, 1), "Kooskia", "Juvenile")])
    det = _det(spark, [("A", T(2025, 5, 1, 8), "BO1"), ("A", T(2025, 5, 1, 9), "BO2"), ("A", T(2025, 5, 1, 10), "BO1"),
                       ("A", T(2025, 5, 1), "GRA"), ("A", T(2025, 5, 3), "GRA")])
    adults = P.adult_detections(det, marks)
    lower = P.passage_events(adults, L.PASSAGE_SITES["Bonneville"], per_site=True)
    assert rows(lower, "obs_sitecode", "obs_datetime") == [("BO1", T(2025, 5, 1, 10)), ("BO2", T(2025, 5, 1, 9))]
    upper = P.passage_events(adults, L.PASSAGE_SITES["Lower Granite"], per_site=False)
    assert rows(upper, "obs_datetime") == [(T(2025, 5, 3),)]


def test_passage_drops_kelts_and_null_group(spark):
    marks = _marks(spark, [("A", "DWOR", "Steelhead", D(2022, 4, 1), None, "Juvenile"),
                           ("B", "DWOR", "Steelhead", D(2022, 4, 1), "Snake Kelts", "Juvenile")])
    det = _det(spark, [("A", T(2025, 5, 1), "GRA"), ("B", T(2025, 5, 1), "GRA")])
    ev = P.passage_events(P.adult_detections(det, marks), ["GRA"], per_site=False)
    assert ev.count() == 0


def test_years_at_large_and_calendar(spark):
    marks = _marks(spark, [("A", "DWOR", "Steelhead", D(2022, 4, 1), "Kooskia", "Juvenile"),
                           ("J", "DWOR", "Chinook", D(2025, 4, 1), "Kooskia", "Juvenile")])
    det = _det(spark, [("A", T(2025, 7, 2, 5), "GRA"), ("J", T(2025, 5, 1), "GRA"), ("X", T(2025, 5, 1), "GRA")])
    a = P.adult_detections(det, marks)
    got = rows(a, "pit_id", "years_at_large", "dummy_date", "spawn_year", "ocean_age")
    assert got == [("A", 3, D(1976, 7, 1), 2026, 3)]


def test_daily_passage_running_totals(spark):
    ev = spark.createDataFrame([(D(1976, 5, d), 2025, "Chinook", "DWOR") for d, n in ((1, 2), (2, 1), (4, 3))
                                for _ in range(n)],
                               "dummy_date date, spawn_year int, species string, hatchery string")
    out = P.daily_passage(ev)
    assert rows(out, "dummy_date", "daily_total", "running_total", "annual_total") == [
        (D(1976, 5, 1), 2, 2, 6), (D(1976, 5, 2), 1, 3, 6), (D(1976, 5, 4), 3, 6, 6)]


def test_inseason_filter_and_max_dates(spark):
    assert P.current_spawn_years(D(2025, 7, 1)) == {"Chinook": 2025, "Steelhead": 2026}
    assert P.current_spawn_years(D(2025, 6, 30)) == {"Chinook": 2025, "Steelhead": 2025}
    lim = dict(rows(P.inseason_max_dates(spark, D(2025, 3, 2))))
    # as-of - 1 day = 1 March 2025 (day 60): spring origin + 60 days, autumn origin + 60 days (Q6)
    assert lim == {"Steelhead": D(1977, 3, 2), "Chinook": D(1976, 3, 1)}


def test_season_dense(spark):
    daily = spark.createDataFrame(
        [(D(1976, 7, 10), 2025, "Chinook", "DWOR", 2, 2, 5, "Dworshak Ladder"),
         (D(1976, 7, 12), 2025, "Chinook", "DWOR", 3, 5, 5, "Dworshak Ladder")],
        "dummy_date date, spawn_year int, species string, hatchery string, daily_total long, running_total long, "
        "annual_total long, dam string")
    lim = spark.createDataFrame([("Chinook", "Dworshak Ladder", D(1976, 7, 14))], "species string, dam string, max_date date")
    out = P.season_dense(daily, lim, "max_date")
    assert rows(out, "dummy_date", "daily_total", "running_total", "annual_total") == [
        (D(1976, 7, 10), 2, 2, 5), (D(1976, 7, 11), 0, 2, 5), (D(1976, 7, 12), 3, 5, 5),
        (D(1976, 7, 13), 0, 5, 5), (D(1976, 7, 14), 0, 5, 5)]
