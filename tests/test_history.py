import datetime as dt

from pyspark.sql import functions as F

from fishladder.operators import history as H
from fishladder.operators import releases as R
from fishladder.sources import lookups as L
from tests.conftest import rows

T = dt.datetime
D = dt.date


def _report(spark, data):
    return spark.createDataFrame(data, "pit_id string, obs_datetime timestamp, site string, sitecode string")


def test_first_per_dam_with_unmapped_site(spark):
    rep = _report(spark, [("A", T(2025, 4, 5, 9), "GRJ x", "GRJ"), ("A", T(2025, 4, 5, 8), "GRS y", "GRS"),
                          ("A", T(2025, 4, 5, 7), "ZZZ z", "ZZZ")])
    long = H.detections_long(H.first_per_site(rep), L.dam_key_df(spark, L.DAM_KEY_INSEASON))
    assert rows(long) == [("A", "LGR", T(2025, 4, 5, 8)), ("A", None, T(2025, 4, 5, 7))]


def test_grid_two_tags_one_dam(spark):
    rep = _report(spark, [("A", T(2025, 4, 5, 9), "GRJ", "GRJ"), ("B", T(2025, 4, 6, 9), "GRJ", "GRJ")])
    grid = H.dam_grid(H.detections_long(H.first_per_site(rep), L.dam_key_df(spark)))
    got = grid.collect()
    assert len(got) == 18 and sum(r["first_detection"] is None for r in got) == 16


def _marks(spark, data):
    return spark.createDataFrame(data, "pit_id string, hatchery string, mark_date date, release_site string, "
                                       "release_sitecode string, release_date date, mark_lifestage string, "
                                       "species string, length_mm double, tag_file string")


MARKS = [("A", "DWOR", D(2025, 1, 1), "DWORNF x", "DWORNF", D(2025, 3, 27), "Juvenile", "Chinook", 100.0, "f"),
         ("C", "DWOR", D(2025, 1, 1), "KOOS x", "KOOS", D(2025, 4, 1), "Juvenile", "Chinook", 100.0, "f"),
         ("U", "DWOR", D(2025, 1, 1), "DWORMS x", "DWORMS", D(2025, 4, 1), "Juvenile", "Steelhead", 90.0, "f"),
         ("K", "CLWH", D(2025, 1, 1), "CLEARC x", "CLEARC", D(2025, 4, 1), "Juvenile", "Steelhead", 90.0, "f")]


def test_inseason_travel_flags_travel_and_exclusion(spark):
    marks = _marks(spark, MARKS)
    rep = _report(spark, [("A", T(2025, 4, 1, 23, 59, 59), "GRJ", "GRJ"), ("A", T(2025, 4, 3), "B2J", "B2J"),
                          ("A", T(2025, 3, 26, 23), "MCJ", "MCJ"), ("U", T(2025, 4, 9), "GRJ", "GRJ")])
    upstream = spark.createDataFrame([("U",), ("K",)], "pit_id string")
    out = H.inseason_travel(marks, H.first_per_site(rep), L.dam_key_df(spark, L.DAM_KEY_INSEASON), upstream)
    got = {r["pit_id"]: r for r in out.collect()}
    assert set(got) == {"A", "C", "K"}  # DWORMS tag in report removed, CLEARC kept (D13)
    a, c = got["A"], got["C"]
    # release 3/27 midnight: 4/1 23:59:59 -> 5, 4/3 -> 7, 3/26 23:00 -> -1
    assert (a["lgr_traveltime"], a["bonn_traveltime"], a["mcn_traveltime"]) == (5, 7, -1)
    assert a["LGR_ch"] == "1" and a["LGS_ch"] == "0"
    assert a["release_group"] == "North Fork Clearwater River Early"
    assert all(c[d] is None for d in L.DAM_LEVELS) and all(c[f"{d}_ch"] == "0" for d in L.DAM_LEVELS)
    assert out.columns == H.history_columns()


def test_juvenile_history_one_row_per_mark(spark):
    marks = R.classify_release_groups(_marks(spark, MARKS + [
        ("Z", "DWOR", D(2024, 1, 1), "DWORNF x", "DWORNF", None, "Juvenile", "Chinook", 1.0, "f"),
        ("J", "DWOR", D(2024, 1, 1), "DWORNF x", "DWORNF", D(2025, 3, 27), "Adult", "Chinook", 1.0, "f")]))
    det = spark.createDataFrame(
        [("A", "observation", T(2025, 4, 10), D(2025, 4, 10), 2025, "GRJ"),
         ("A", "observation", T(2026, 9, 1), D(2026, 9, 1), 2026, "BO1"),   # adult year: not juvenile
         ("Z", "observation", T(2025, 4, 10), D(2025, 4, 10), 2025, "GRJ"),  # no release date
         ("J", "observation", T(2025, 4, 10), D(2025, 4, 10), 2025, "GRJ")],  # not a juvenile mark
        "pit_id string, obs_type string, obs_datetime timestamp, obs_date date, obs_year int, obs_sitecode string")
    juv = H.juvenile_history(marks, H.attach_dams(det, L.dam_key_df(spark), "obs_sitecode"))
    got = {r["pit_id"]: r for r in juv.collect()}
    assert len(got) == juv.count() == 6
    assert got["A"]["LGR"] == T(2025, 4, 10) and got["A"]["BONN"] is None and got["A"]["lgr_traveltime"] == 14
    assert got["Z"]["LGR"] is None and got["J"]["LGR"] is None
    assert all(got["C"][f"{d}_ch"] == "0" for d in L.DAM_LEVELS)  # Q8


def test_first_per_site_day_and_history_normalisation(spark):
    raw = spark.createDataFrame([("A", "Mark", "4/1/2025 8:00:00 AM", "DWORNF"),
                                 ("A", "Observation", "4/10/2025 9:00:00 AM", "GRJ"),
                                 ("A", "Observation", "4/10/2025 8:59:00 AM", "GRJ"),
                                 ("A", "Recapture", "4/11/2025 1:00:00 PM", "GRJ")],
                                "`Tag Code` string, `Event Type Name` string, `Event Date Time Value` string, "
                                "`Event Site Code Value` string")
    det = H.normalize_tag_history(raw)
    assert det.where(F.col("obs_type") == "mark").count() == 0
    day = H.first_per_site_day(det)
    assert rows(day, "obs_date", "obs_datetime", "obs_type") == [
        (D(2025, 4, 10), T(2025, 4, 10, 8, 59), "observation"), (D(2025, 4, 11), T(2025, 4, 11, 13), "recapture")]
