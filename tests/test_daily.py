"""The daily merge over three days of files equals the rebuild over all of
them, and only the tags with new detections are worked out again."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from fishladder.operators import history as H
from fishladder.plans.daily import merge_histories, merge_reports
from fishladder.plans.refresh import build_catalog, inputs_from_driver
from fishladder.sources.readers import read_snapshot
from fishladder.sources.sinks import current_number, manifest

SF = "/root/testdata/sf0.001"
HISTORY = ["daily_detections", "juv_history", "adult_detections", "emigration_history"]
SEASON = ["first_detections", "travel", "emigration_all"]


def rows(spark, root, name, cols):
    return sorted(repr([r[c] for c in cols]) for r in read_snapshot(spark, f"{root}/{name}").collect())


@pytest.fixture(scope="module")
def inputs(spark):
    return inputs_from_driver(spark, SF)


def test_three_days_equal_the_rebuild(spark, inputs, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("daily"))
    whole, root = f"{base}/whole", f"{base}/daily"
    build_catalog(spark, inputs, whole)

    def landed(df, day):            # most rows on the first day; the later ones hold few tags, some of them new
        h = F.pmod(F.xxhash64(*df.columns), F.lit(100))
        part = F.when(h < 3, 3).when(h < 10, 2).otherwise(1)
        few = F.col("pit_id") % 8 == 0
        return df.where(F.when(few, part).otherwise(1) == day)
    up = inputs.upstream
    build_catalog(spark, dataclasses.replace(inputs, tag_history=landed(inputs.tag_history, 1), reports=landed(inputs.reports, 1),
                                             upstream=landed(up, 1)), root)
    for day in (2, 3):
        merge_histories(spark, root, landed(inputs.tag_history, day), inputs.dam_key, inputs.drop_spawn_year)
        so_far = landed(up, 1).unionByName(landed(up, 2)) if day == 2 else up
        n = merge_reports(spark, root, landed(inputs.reports, day), landed(up, day), inputs.marks_current,
                          inputs.dam_key_inseason, so_far, inputs.release_dates)
        assert 0 < n < 0.2 * inputs.marks_current.count()
    for name in HISTORY + SEASON:
        cols = sorted(read_snapshot(spark, f"{whole}/{name}").columns)
        assert sorted(read_snapshot(spark, f"{root}/{name}").columns) == cols, name
        assert rows(spark, root, name, cols) == rows(spark, whole, name, cols), name

    # the same rows once more change nothing, and no partition is written again
    before = {n: manifest(spark, f"{root}/{n}")["parts"] for n in HISTORY[:3]}
    merge_histories(spark, root, landed(inputs.tag_history, 3), inputs.dam_key, inputs.drop_spawn_year)
    for name in HISTORY[:3]:
        now = manifest(spark, f"{root}/{name}")["parts"]
        assert {d: p["version"] for d, p in now.items()} == {d: p["version"] for d, p in before[name].items()}, name
    numbers = [current_number(spark, f"{root}/{n}") for n in HISTORY]
    nothing = merge_histories(spark, root, inputs.tag_history.where("false"), inputs.dam_key, inputs.drop_spawn_year)
    assert all(v == [] for v in nothing.values())
    assert numbers == [current_number(spark, f"{root}/{n}") for n in HISTORY]


def test_history_from_bucketed_tables_has_no_shuffle(spark, inputs, tmp_path_factory):
    from fishladder.operators import releases as R
    from fishladder.sources.sinks import write_snapshot
    root = str(tmp_path_factory.mktemp("bucketed"))
    write_snapshot(R.classify_release_groups(inputs.marks_history, single_year=inputs.single_year), f"{root}/marks", "release_year",
                   bucket_by="pit_id")
    write_snapshot(H.first_per_site_day(inputs.tag_history), f"{root}/daily", "obs_year", bucket_by="pit_id")
    marks, daily = read_snapshot(spark, f"{root}/marks"), read_snapshot(spark, f"{root}/daily")
    juv = H.juvenile_history(marks, H.attach_dams(daily, inputs.dam_key, "obs_sitecode"), by_tag=True)
    plan = juv._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and plan.count("Bucketed: true") == 2
    want = H.juvenile_history(R.classify_release_groups(inputs.marks_history, single_year=inputs.single_year),
                              H.attach_dams(H.first_per_site_day(inputs.tag_history), inputs.dam_key, "obs_sitecode"))
    key = lambda df: sorted(repr([r[c] for c in juv.columns]) for r in df.collect())
    assert key(juv) == key(want)
