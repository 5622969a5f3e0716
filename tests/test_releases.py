import datetime as dt

from fishladder.operators import releases as R
from tests.conftest import rows

D = dt.date


def _marks(spark, data):
    return spark.createDataFrame(
        [(p, "DWOR", d, s + " x", s, d, "Juvenile", sp, 1.0, "f") for p, s, sp, d in data],
        "pit_id string, hatchery string, mark_date date, release_site string, release_sitecode string, "
        "release_date date, mark_lifestage string, species string, length_mm double, tag_file string")


def test_release_order(spark):
    m = _marks(spark, [("a", "DWORNF", "Chinook", D(2021, 3, 27)), ("b", "DWORNF", "Chinook", D(2021, 3, 27)),
                       ("c", "DWORNF", "Chinook", D(2021, 4, 10)), ("d", "DWORNF", "Chinook", D(2022, 4, 2)),
                       ("e", "DWORNF", "Chinook", None)])
    for limit in (R.TALLY_ROWS, 0):                   # broadcast, and salted
        got = rows(R.release_order(m, limit), "pit_id", "release_order")
        assert got == [("a", 1), ("b", 1), ("c", 2), ("d", 1), ("e", 1)]


def test_release_group_rules(spark):
    m = _marks(spark, [("s", "DWORNF", "Chinook", D(2020, 4, 1)),
                       ("e", "DWORNF", "Chinook", D(2021, 3, 1)), ("l", "DWORNF", "Chinook", D(2021, 4, 1)),
                       ("x", "DWORNF", "Chinook", D(2021, 5, 1)), ("c", "DWORMS", "Coho", D(2021, 4, 1)),
                       ("h", "DWORMS", "Steelhead", D(2021, 4, 1)), ("u", "NOPE", "Chinook", D(2021, 4, 1)),
                       ("k", "SNAKE2", "Steelhead", D(2021, 4, 1))])
    got = dict(rows(R.classify_release_groups(m), "pit_id", "release_group"))
    nf = "North Fork Clearwater River"
    assert got == {"s": nf + " Single", "e": nf + " Early", "l": nf + " Late", "x": None, "c": None,
                   "h": "Clearwater River", "u": None, "k": "Snake Kelts"}


def test_release_group_dated(spark):
    m = _marks(spark, [("e", "CLWHNF", "Chinook", D(2025, 3, 27)), ("l", "DWORNF", "Chinook", D(2025, 4, 10)),
                       ("o", "DWORNF", "Chinook", D(2025, 4, 11)), ("m", "DWORMS", "Chinook", D(2025, 4, 11))])
    got = dict(rows(m.select("pit_id", R.release_group_dated_expr().alias("g")), "pit_id", "g"))
    nf = "North Fork Clearwater River"
    assert got == {"e": nf + " Early", "l": nf + " Late", "o": None, "m": "Clearwater River"}


def test_normalize_marks(spark):
    raw = spark.createDataFrame([("3D9.1", "DWOR - Dworshak NFH", "DWORNF - NF Clearwater", "3/27/2025", "10/01/2024",
                                  "Juvenile", "Chinook", 101.0, "f1"),
                                 ("3D9.2", "KOOS", "KOOS", "bad", "", "Juvenile", "Chinook", None, "f1")],
                                "`Tag Code` string, `Mark Site Name` string, `Release Site Name` string, "
                                "`Release Date MMDDYYYY` string, `Mark Date MMDDYYYY` string, "
                                "`Mark Life Stage Value` string, `Species Name` string, `Length mm` double, "
                                "`Mark File Name` string")
    got = {r["pit_id"]: r for r in R.normalize_marks(raw).collect()}
    assert got["3D9.1"]["hatchery"] == "DWOR" and got["3D9.1"]["release_sitecode"] == "DWORNF"
    assert got["3D9.1"]["release_date"] == D(2025, 3, 27) and got["3D9.1"]["mark_date"] == D(2024, 10, 1)
    assert got["3D9.2"]["release_date"] is None and got["3D9.2"]["mark_date"] is None
