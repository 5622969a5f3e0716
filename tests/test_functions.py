import datetime as dt

from pyspark.sql import functions as F

from fishladder.functions import (adult_calendar, mdy, mdy_hms, ocean_age, parse_mixed_date, str_c,
                                  travel_days, window_calendar, word)

D = dt.date


def test_word_and_str_c(spark):
    df = spark.createDataFrame([("GRJ - Lower Granite", "Jack_Chinook"), ("GRS", None)], "a string, b string")
    out = df.select(word("a", 1).alias("w1"), word("a", 2, "_").alias("w2"), word("b", 2, "_").alias("w3"),
                    str_c(F.col("a"), F.col("b"), sep=" ").alias("c")).collect()
    assert out[0]["w1"] == "GRJ" and out[0]["w3"] == "Chinook"
    assert out[1]["w1"] == "GRS" and out[1]["w2"] is None and out[1]["w3"] is None
    assert out[1]["c"] is None  # NULL part -> NULL (N8)


def test_mdy_parsers(spark):
    df = spark.createDataFrame([("4/5/2025", "04/05/2025 10:00:00"), ("04/05/2025", "4/5/2025 1:02:03 PM"),
                                ("garbage", "garbage")], "d string, t string")
    out = df.select(mdy("d").alias("d"), mdy_hms("t").alias("t")).collect()
    assert out[0]["d"] == D(2025, 4, 5) and out[1]["d"] == D(2025, 4, 5)
    assert out[0]["t"] == dt.datetime(2025, 4, 5, 10, 0, 0)
    assert out[1]["t"] == dt.datetime(2025, 4, 5, 13, 2, 3)
    assert out[2]["d"] is None and out[2]["t"] is None  # N9


def test_mixed_dates(spark):
    df = spark.createDataFrame([("2025-04-13",), ("4/13/2025",), ("13/4/2025",), ("",), (None,)], "d string")
    assert [r[0] for r in df.select(parse_mixed_date("d")).collect()] == [D(2025, 4, 13)] * 3 + [None, None]


def test_adult_calendar_fixture(spark):
    cases = [("Steelhead", "2025-01-01", D(1977, 1, 2), 2025), ("Steelhead", "2025-03-01", D(1977, 3, 2), 2025),
             ("Steelhead", "2025-07-01", D(1977, 7, 2), 2025), ("Steelhead", "2025-07-02", D(1976, 7, 1), 2026),
             ("Steelhead", "2024-07-01", D(1976, 7, 1), 2025), ("Chinook", "2025-03-01", D(1976, 2, 29), 2025)]
    df = spark.createDataFrame([(s, t) for s, t, _, _ in cases], "species string, t string") \
        .withColumn("ts", F.to_timestamp("t"))
    dummy, spawn = adult_calendar("species", "ts")
    out = df.select(dummy.alias("d"), spawn.alias("y")).collect()
    assert [(r["d"], r["y"]) for r in out] == [(d, y) for _, _, d, y in cases]


def test_ocean_age(spark):
    df = spark.createDataFrame([("Steelhead", 2025, 2022), ("Chinook", 2025, 2022)], "species string, sy int, ry int")
    assert [r[0] for r in df.select(ocean_age("species", "sy", "ry")).collect()] == [2, 3]


def test_window_calendar_fixture(spark):
    cases = [("Steelhead", D(2024, 2, 29), None, 2024), ("Steelhead", D(2024, 6, 30), D(1977, 6, 30), 2024),
             ("Steelhead", D(2024, 7, 1), D(1976, 7, 1), 2025), ("Coho", D(2024, 2, 29), D(1976, 2, 29), 2024)]
    df = spark.createDataFrame([(s, d) for s, d, _, _ in cases], "species string, date date")
    jf, dummy, spawn = window_calendar("species", "date")
    out = df.select(dummy.alias("d"), spawn.alias("y")).collect()
    assert [(r["d"], r["y"]) for r in out] == [(d, y) for _, _, d, y in cases]  # N10, Q13


def test_travel_days_fixture(spark):
    rel = dt.datetime(2025, 4, 1)
    ts = [dt.datetime(2025, 4, 1, 23, 59, 59), dt.datetime(2025, 4, 3), dt.datetime(2025, 3, 31, 23)]
    df = spark.createDataFrame([(rel, t) for t in ts], "r timestamp, t timestamp")
    assert [r[0] for r in df.select(travel_days("t", "r")).collect()] == [0, 2, -1]
