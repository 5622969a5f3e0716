"""D5 by packed numbers: same rows as the pick of a (time, type) pair, for any
event types, ties, missing values and days; and no sort in the plan."""

import random

import pytest

from fishladder.operators import history as H
from fishladder.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"
SCHEMA = "pit_id string, obs_type string, obs_datetime timestamp, obs_date date, obs_sitecode string"


def rows_of(df):
    cols = ["pit_id", "obs_date", "obs_sitecode", "obs_datetime", "obs_type", "obs_year"]
    assert df.columns == cols
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def detections(spark, seed, types):
    from datetime import datetime, timedelta
    rnd = random.Random(seed)
    rows = []
    for _ in range(400):
        at = None if rnd.random() < 0.05 else datetime(rnd.choice([1931, 1969, 2016, 2045]), 3, 4) + timedelta(
            days=rnd.randrange(3), microseconds=rnd.choice([0, 1, 43_200_000_000, 86_399_999_999]))
        day = None if at is None or rnd.random() < 0.05 else (at.date() if rnd.random() < 0.9 else at.date() + timedelta(days=400))
        rows.append((rnd.choice(["a", "b", None]), rnd.choice(types), at, day, rnd.choice(["S1", "S2", None])))
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("types", [["observation", "recapture"], ["z", "a", None, "", "\u00e9", "Z", "observation 2"], [None]])
def test_packed_equals_the_pair(spark, types):
    det = detections(spark, len(types), types)
    assert rows_of(H.first_per_site_day(det)) == rows_of(H.first_per_site_day(det, max_types=0))


def test_types_keep_their_order(spark):
    det = detections(spark, 7, ["b", "a", None, "\u00e9", "B"])
    got = {r["obs_type"]: r["code"] for r in H.event_types(det).collect()}
    assert got == {"B": 1, "a": 2, "b": 3, "\u00e9": 4}


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert H.first_per_site_day(empty).count() == 0
    assert H.first_per_site_day(empty).schema["obs_datetime"].dataType.simpleString() == "timestamp"


@pytest.mark.parametrize("name", ["first_per_site_day", "adult_complete", "season_dense", "b05", "years_at_large"])
def test_first_detections_are_hash_aggregations(spark, name):
    plan = REGISTRY[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    if name == "first_per_site_day":
        assert "partial_min" in plan
