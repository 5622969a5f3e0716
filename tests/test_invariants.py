
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fishladder.operators import history as H
from fishladder.operators.verbs import first_by, running_totals
from fishladder.plans.queries import REGISTRY
from fishladder.sources import driver as Dv
from fishladder.sources import lookups as L

SF = "/root/testdata/sf0.001"


def test_one_history_row_per_mark_and_flags_match_times(spark):
    juv = REGISTRY["juvenile_history"](spark, SF)
    marks = Dv.marks(spark, SF)
    assert juv.count() == marks.count() == juv.select("pit_id").distinct().count()
    for d in L.DAM_LEVELS:
        bad = juv.where((F.col(f"{d}_ch") == "1") != F.col(d).isNotNull()).count()
        assert bad == 0, d


def test_grid_is_tags_times_levels(spark):
    grid = REGISTRY["dam_grid"](spark, SF)
    long = REGISTRY["first_per_dam"](spark, SF)
    tags = long.select("pit_id").distinct().count()
    has_null = long.where(F.col("dam_code").isNull()).count() > 0
    assert grid.count() == tags * (len(L.DAM_LEVELS) + (1 if has_null else 0))


def test_running_total_ends_at_annual_total(spark):
    for name, keys in (("adult_complete", ["dam", "spawn_year", "species", "hatchery"]),
                       ("window_all", ["spawn_year", "dam", "species", "life_stage", "origin"])):
        df = REGISTRY[name](spark, SF)
        daily = "daily_total" if "daily_total" in df.columns else "count"
        agg = df.groupBy(*keys).agg(F.max("running_total").alias("last"), F.max("annual_total").alias("tot"),
                                    F.sum(daily).alias("sum"))
        assert agg.where((F.col("last") != F.col("tot")) | (F.col("tot") != F.col("sum"))).count() == 0, name


def test_unpivot_rows_are_rows_times_columns(spark):
    rep = Dv.window_report(spark, SF, "current")
    assert REGISTRY["window_long"](spark, SF).count() == rep.count() * len(L.WINDOW_COLUMNS_CURRENT)


def test_densified_days_cover_each_group(spark):
    dense = REGISTRY["season_dense"](spark, SF)
    per = dense.groupBy("species", "hatchery", "spawn_year", "dam").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("dummy_date").alias("d"))
    assert per.where(F.col("n") != F.col("d")).count() == 0  # one row per day


def test_union_adds_counts(spark):
    a = REGISTRY["adult_complete"](spark, SF).count()
    b = REGISTRY["adult_inseason"](spark, SF).count()
    assert REGISTRY["adult_all_dams"](spark, SF).count() == a + b


def test_upstream_exclusion_only_removes_onsite_tags(spark):
    travel = REGISTRY["upstream_excluded"](spark, SF)
    marks = Dv.marks(spark, SF)
    removed = marks.join(travel, "pit_id", "left_anti")
    assert removed.where(~F.col("release_sitecode").isin(L.ONSITE_RELEASE_CODES)).count() == 0
    assert removed.join(Dv.upstream_tags(spark, SF), "pit_id", "left_anti").count() == 0


@settings(max_examples=5, deadline=None)
@given(st.integers(min_value=0, max_value=10_000), st.integers(min_value=1, max_value=9))
def test_permuting_input_never_changes_results(spark, seed, parts):
    base = H.first_per_site(Dv.sub_day_detections(spark, SF))
    rnd = random.Random(seed)
    rows = Dv.sub_day_detections(spark, SF).collect()
    rnd.shuffle(rows)
    shuffled = spark.createDataFrame(rows, Dv.sub_day_detections(spark, SF).schema).repartition(parts)
    assert sorted(H.first_per_site(shuffled).collect()) == sorted(base.collect())


def test_running_totals_ignore_input_order(spark):
    df = spark.createDataFrame([("g", d, n) for d, n in [(3, 1), (1, 4), (2, 2), (5, 7)]], "k string, d int, n long")
    a = sorted(running_totals(df, ["k"], ["d"], "n").collect())
    b = sorted(running_totals(df.repartition(3).orderBy(F.rand(1)), ["k"], ["d"], "n").collect())
    assert a == b


def test_first_by_equals_window_definition(spark):
    det = Dv.detections(spark, SF)
    got = sorted(first_by(det, ["pit_id", "obs_date", "obs_sitecode"], ["obs_datetime"],
                          ["obs_type", "obs_year"]).collect())
    from pyspark.sql import Window
    w = Window.partitionBy("pit_id", "obs_date", "obs_sitecode").orderBy("obs_datetime", "obs_type", "obs_year")
    ref = (det.where(F.col("obs_datetime").isNotNull()).withColumn("rn", F.row_number().over(w))
              .where("rn = 1").select("pit_id", "obs_date", "obs_sitecode", "obs_datetime", "obs_type", "obs_year"))
    assert got == sorted(ref.collect())


def test_panels_are_the_same_on_the_filled_tables(spark):
    """B6, B7 and B19 are registered on the tables before gap filling and
    summarising; the dashboard hands them the filled and summarised ones."""
    from fishladder.operators import summaries as S
    from fishladder.operators import window_counts as WC
    from fishladder.plans import dashboard as B
    from fishladder.plans import queries as Q
    from fishladder.sources import driver as D
    names = {role: Q.L.HATCHERY_NAMES[code] for code, role in Q.HATCH.items()}
    dense = Q.adults_sel(spark, SF)
    key = lambda df: sorted(str(r.asDict()) for r in df.collect())
    hatcheries = list(Q.HATCH.values())
    assert key(B.adult_ytd(dense, "Steelhead", D.AS_OF, hatcheries, names)) == key(REGISTRY["b06"](spark, SF))
    assert key(B.adult_last_week(dense, "Steelhead", D.AS_OF, hatcheries)) == key(REGISTRY["b07"](spark, SF))
    summaries = S.emigration_all(S.emigration_summary(Q.juvenile_history_df(spark, SF)),
                                 S.emigration_summary(Q.inseason_travel_df(spark, SF)))
    full = B.control_limits(Q.adult_bind_df(spark, SF), WC.dashboard_window(Q.window_table_df(spark, SF)), summaries,
                            Q.gauge_year_df(spark, SF), D.AS_OF)
    assert key(full) == key(REGISTRY["b19"](spark, SF))
