"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

They run the library operators over the driver tables in their domain roles
(``fishladder.sources.driver``); all read whole tables.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fishladder.functions.dates import date_order_counts, parse_mixed_date_by
from fishladder.operators import history as H
from fishladder.operators import releases as R
from fishladder.operators import summaries as S
from fishladder.session import bound_tasks, input_bytes
from fishladder.sources import driver as D
from fishladder.sources.subtables import input_version, kept_subtable, path_exists, subtable

REGISTRY: dict = {}

# Sub-plans shared inside one query are built once per query call: the same
# DataFrame object is reused, which saves py4j round trips and hands
# Catalyst identical subtrees (their exchanges are then reused). The memo
# lives only while one registered query is being built (per thread). Tables
# that several queries need are sub-tables of the session (``stored``).
_STATE = threading.local()


def naive_timestamps(df: DataFrame) -> DataFrame:
    """Output boundary: timestamps as TIMESTAMP_NTZ (wall-clock UTC, as read
    from the inputs), the type plain SQL TIMESTAMP corresponds to."""
    from pyspark.sql.types import TimestampType
    ts = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ts}) if ts else df


def query(name):
    def deco(fn):
        def run(spark, sf):
            outer = getattr(_STATE, "memo", None)
            _STATE.memo = {} if outer is None else outer
            try:
                if outer is not None:
                    return fn(spark, sf)
                bound_tasks(spark, tables_bytes(spark, sf))
                return naive_timestamps(fn(spark, sf))
            finally:
                _STATE.memo = outer
        run.__name__ = fn.__name__
        REGISTRY[name] = run
        return run
    return deco


def shared(fn):
    def get(spark, sf, *args):
        memo = getattr(_STATE, "memo", None)
        if memo is None:
            return fn(spark, sf, *args)
        key = (id(fn), id(spark), sf, args)
        if key not in memo:
            memo[key] = fn(spark, sf, *args)
        return memo[key]
    get.__name__ = fn.__name__
    return get


def table_paths(sf):
    return [f"{sf.rstrip('/')}/{t}.parquet" for t in ("orders", "customer", "lineitem", "events")]


def tables_bytes(spark, sf) -> int:
    return input_bytes(spark, [p for p in table_paths(sf) if path_exists(spark, p)])


@shared
def inputs_version(spark, sf):
    return input_version(spark, table_paths(sf))


def stored(fn):
    """A sub-table that several queries of a session read: built once per input
    version and kept in the shared folder. ``.direct`` is the plan itself, for
    the query that stands for the operator; ``.kept`` the table if the session
    has it already, else None."""
    direct = shared(fn)

    @shared
    def get(spark, sf, *args):
        return subtable(spark, fn.__name__, (sf, *args), inputs_version(spark, sf), lambda: direct(spark, sf, *args))

    @shared
    def kept(spark, sf, *args):
        return kept_subtable(spark, fn.__name__, (sf, *args), inputs_version(spark, sf))
    get.direct, get.kept = direct, kept
    return get


# driver views used by several helpers
@shared
def marks_v(spark, sf):
    return D.marks(spark, sf)


@stored
def release_tally_v(spark, sf):
    return R.release_tally(marks_v(spark, sf))


@stored
def marks_table_v(spark, sf):
    return R.classify_release_groups(marks_v(spark, sf), single_year=D.SINGLE_YEAR, tally=release_tally_v(spark, sf))


@shared
def detections_v(spark, sf):
    return D.detections(spark, sf)


@stored
def event_types_v(spark, sf):
    return H.event_types(detections_v(spark, sf))


@shared
def day_first_df(spark, sf):
    return H.first_per_site_day(detections_v(spark, sf), event_types_v(spark, sf))


# --- shared building blocks ---------------------------------------------------------

@shared
def hist_detections_with_dams(spark, sf) -> DataFrame:
    return H.attach_dams(detections_v(spark, sf), D.dam_key(spark), "obs_sitecode")


@shared
def juvenile_history_df(spark, sf) -> DataFrame:
    return H.juvenile_history(marks_table_v(spark, sf), hist_detections_with_dams(spark, sf))


@shared
def inseason_first_per_site(spark, sf) -> DataFrame:
    return H.first_per_site(D.report(spark, sf))


def inseason_travel_plan(spark, sf, levels=None) -> DataFrame:
    return H.inseason_travel(marks_v(spark, sf), inseason_first_per_site(spark, sf), D.dam_key(spark),
                             D.upstream_tags(spark, sf), levels=levels, release_dates=D.RELEASE_DATES)


@stored
def inseason_travel_df(spark, sf) -> DataFrame:
    return inseason_travel_plan(spark, sf)


def inseason_travel_at(spark, sf, dams) -> DataFrame:
    """The travel table with the columns of ``dams`` (at least), for a table counted
    from it: the kept table where the session has it. A session that does not have
    it makes no table of all dams and columns only to read a few of them."""
    kept = inseason_travel_df.kept(spark, sf)
    return inseason_travel_plan(spark, sf, dams) if kept is None else kept


@shared
def inseason_wide_df(spark, sf) -> DataFrame:
    """Marks + nine first-detection columns (before flags/travel/exclusion)."""
    det = H.attach_dams(inseason_first_per_site(spark, sf), D.dam_key(spark), "sitecode")
    wide = H.wide_first_detections(det).withColumnRenamed("pit_id", "_pid")
    m = marks_v(spark, sf).withColumn("release_year", F.year("release_date"))
    return m.join(wide, F.col("pit_id") == F.col("_pid"), "left").drop("_pid")


# --- ingest and normalisation ------------------------------------------------------------

@query("marks_clean")
def q_marks_clean(spark, sf):
    return R.normalize_marks(D.marks_raw(spark, sf))


@query("detections_clean")
def q_detections_clean(spark, sf):
    return H.normalize_tag_history(D.tag_history_raw(spark, sf))


@query("report_clean")
def q_report_clean(spark, sf):
    return H.normalize_report(D.report_raw(spark, sf))


@shared
def dated_text(spark, sf):
    w = D.window_report(spark, sf, "finished")
    fmt = (F.when(F.col("Project") == "Lower Granite", F.date_format("Date", "yyyy-MM-dd"))
            .when(F.col("Project") == "Bonneville", F.date_format("Date", "M/d/yyyy"))
            .otherwise(F.date_format("Date", "d/M/yyyy")))
    t = w.select(F.col("Project").alias("dam"), fmt.alias("date_text"))
    return t.withColumn("date", F.col("date_text"))


@stored
def date_orders_v(spark, sf):
    return date_order_counts(dated_text(spark, sf), "date", ["dam"])


@query("mixed_dates")
def q_mixed_dates(spark, sf):
    # the dam stands for the file the row came from
    return parse_mixed_date_by(dated_text(spark, sf), "date", ["dam"], counts=date_orders_v(spark, sf))


# --- first events, dams, wide histories -------------------------------------------------

@query("first_per_site")
def q_first_per_site(spark, sf):
    return H.first_per_site(D.sub_day_detections(spark, sf))


@query("first_per_site_day")
def q_first_per_site_day(spark, sf):
    return day_first_df(spark, sf)


@query("first_per_site_stream")
def q_first_per_site_stream(spark, sf):
    """D4 by the stream's own steps over the report rows: the updates of one
    batch, folded like the batch log (a stream itself runs only when started)."""
    from fishladder.streaming.inseason import fold, updates
    return fold(updates(D.report(spark, sf)))


@query("first_per_dam")
def q_first_per_dam(spark, sf):
    return H.detections_long(inseason_first_per_site(spark, sf), D.dam_key(spark))


@query("dam_grid")
def q_dam_grid(spark, sf):
    return H.dam_grid(H.detections_long(inseason_first_per_site(spark, sf), D.dam_key(spark)))


@query("history_wide")
def q_history_wide(spark, sf):
    cols = ["pit_id", "species", "tag_file", "hatchery", "release_date", "release_year", "mark_date",
            "release_sitecode", "length_mm"] + H.L.DAM_LEVELS
    return inseason_wide_df(spark, sf).select(*cols)


@query("capture_flags")
def q_capture_flags(spark, sf):
    df = H.capture_flags(inseason_wide_df(spark, sf))
    return df.select("pit_id", *[f"{c}_ch" for c in H.L.DAM_LEVELS])


@query("travel_days")
def q_travel_days(spark, sf):
    df = inseason_wide_df(spark, sf).withColumn("release_ts", F.col("release_date").cast("timestamp"))
    df = H.travel_times(df)
    lv = H.L.DAM_LEVELS
    return df.select("pit_id", "release_time", *[f"{c}_time" for c in lv],
                     *[f"{c.lower()}_traveltime" for c in lv])


@query("upstream_excluded")
def q_upstream_excluded(spark, sf):
    return inseason_travel_df.direct(spark, sf)


# --- releases ----------------------------------------------------------------------------------

@query("release_order")
def q_release_order(spark, sf):
    m = R.release_order(marks_v(spark, sf), tally=release_tally_v(spark, sf))
    return m.select("pit_id", "hatchery", "species", "release_sitecode", "release_date",
                    "release_year", "release_order")


@query("release_group")
def q_release_group(spark, sf):
    return marks_table_v.direct(spark, sf)


@query("release_group_dated")
def q_release_group_dated(spark, sf):
    m = marks_v(spark, sf)
    return m.select("pit_id", "release_sitecode", "release_date",
                    R.release_group_dated_expr(D.RELEASE_DATES).alias("release_group"))


@query("years_at_large")
def q_years_at_large(spark, sf):
    det = day_first_df(spark, sf)
    m = marks_table_v(spark, sf).select(F.col("pit_id").alias("_pid"), "release_year")
    j = det.join(m, F.col("pit_id") == F.col("_pid"), "left").drop("_pid")
    yal = F.col("obs_year") - F.col("release_year")
    return (j.select("pit_id", "obs_date", "obs_sitecode", "release_year", "obs_year",
                     yal.alias("years_at_large"))
             .where(F.col("years_at_large").isNotNull())
             .withColumn("stage", F.when(F.col("years_at_large") == 0, "juvenile")
                         .when(F.col("years_at_large") > 0, "adult")))


@stored
def history_counts(spark, sf) -> DataFrame:
    """What all summaries of the histories are made of."""
    kept = marks_table_v.kept(spark, sf)
    marks = marks_table_v.direct(spark, sf) if kept is None else kept
    return S.summary_counts(H.juvenile_history(marks, hist_detections_with_dams(spark, sf), S.SUMMARY_DAMS))


@stored
def inseason_counts(spark, sf) -> DataFrame:
    return S.summary_counts(inseason_travel_at(spark, sf, S.SUMMARY_DAMS))


@stored
def history_buckets(spark, sf) -> DataFrame:
    return S.median_buckets(history_counts(spark, sf))


@stored
def inseason_buckets(spark, sf) -> DataFrame:
    return S.median_buckets(inseason_counts(spark, sf))


@query("juvenile_history")
def q_juvenile_history(spark, sf):
    return juvenile_history_df(spark, sf)


@query("emigration_summary")
def q_emigration_summary(spark, sf):
    return S.emigration_summary(juvenile_history_df(spark, sf))


@query("emigration_all")
def q_emigration_all(spark, sf):
    hist, cur = history_counts(spark, sf), inseason_counts(spark, sf)
    return S.emigration_all(S.summary_of_counts(hist, buckets=history_buckets(spark, sf)),
                            S.summary_of_counts(cur, buckets=inseason_buckets(spark, sf)))


# --- adult passage -----------------------------------------------------------------------------

from fishladder.operators import passage as P  # noqa: E402
from fishladder.sources import lookups as L  # noqa: E402


@shared
def history_adults_df(spark, sf) -> DataFrame:
    day_first = day_first_df(spark, sf)
    return P.adult_detections(day_first, marks_table_v(spark, sf), L.ADULT_OBS_TYPES)


@shared
def inseason_adults_df(spark, sf) -> DataFrame:
    return P.inseason_adult_detections(D.adult_report(spark, sf), marks_table_v(spark, sf))


@stored
def adult_complete_df(spark, sf) -> DataFrame:
    day_first = day_first_df(spark, sf)
    return P.passage_tables_reduced(day_first, marks_table_v(spark, sf), D.PASSAGE_SITES, L.PASSAGE_PER_SITE,
                                    P.complete_filter(D.HISTORY_DROP_SPAWN_YEAR), obs_types=L.ADULT_OBS_TYPES)


@stored
def adult_inseason_df(spark, sf) -> DataFrame:
    rep = D.adult_report(spark, sf).where(F.col("report_species") != "Coho")
    return P.passage_tables_reduced(rep, marks_table_v(spark, sf), D.PASSAGE_SITES, L.PASSAGE_PER_SITE,
                                    lambda df: P.inseason_filter(df, D.AS_OF))


@query("adult_calendar")
def q_adult_calendar(spark, sf):
    return history_adults_df(spark, sf).select(
        "pit_id", "obs_datetime", "obs_sitecode", "obs_type", "species", "hatchery", "release_group",
        "release_year", "obs_year", "years_at_large", "day_of_year", "dummy_date", "spawn_year", "ocean_age")


@query("last_passage")
def q_last_passage(spark, sf):
    return P.passage_events(history_adults_df(spark, sf), D.PASSAGE_SITES["Lower Granite"], per_site=False)


@query("last_passage_site")
def q_last_passage_site(spark, sf):
    return P.passage_events(history_adults_df(spark, sf), D.PASSAGE_SITES["Bonneville"], per_site=True)


@query("adult_daily")
def q_adult_daily(spark, sf):
    ev = P.passage_events(inseason_adults_df(spark, sf), D.PASSAGE_SITES["Lower Granite"], per_site=False)
    return P.daily_passage(ev)


@query("adult_inseason")
def q_adult_inseason(spark, sf):
    return adult_inseason_df.direct(spark, sf)


@query("adult_complete")
def q_adult_complete(spark, sf):
    return adult_complete_df.direct(spark, sf)


@query("adult_all_dams")
def q_adult_all_dams(spark, sf):
    return adult_complete_df(spark, sf).unionByName(adult_inseason_df(spark, sf))


@query("season_dense")
def q_season_dense(spark, sf):
    return P.season_dense(adult_complete_df(spark, sf), L.species_max_dates_df(spark), "max_date")


@query("season_dense_asof")
def q_season_dense_asof(spark, sf):
    return P.season_dense(adult_inseason_df(spark, sf), P.inseason_max_dates(spark, D.AS_OF), "inseason_max")


@query("qa_ocean_age")
def q_qa_ocean_age(spark, sf):
    return S.tally(history_adults_df(spark, sf), ["species", "ocean_age"])


# --- window counts -----------------------------------------------------------------------------

from fishladder.operators import window_counts as WC  # noqa: E402


@shared
def window_current_df(spark, sf) -> DataFrame:
    return WC.window_current(WC.window_daily(D.window_report(spark, sf, "current")), D.AS_OF)


@shared
def window_finished_df(spark, sf) -> DataFrame:
    daily = WC.window_daily(D.window_report(spark, sf, "finished"), L.WINDOW_COLUMNS_FINISHED)
    return WC.window_finished(daily, D.AS_OF)


@stored
def window_table_df(spark, sf) -> DataFrame:
    return WC.window_table(window_current_df(spark, sf), window_finished_df(spark, sf))


@query("window_long")
def q_window_long(spark, sf):
    return WC.window_long(D.window_report(spark, sf, "current"))


@query("window_calendar")
def q_window_calendar(spark, sf):
    return WC.with_window_calendar(WC.window_long(D.window_report(spark, sf, "current")))


@query("window_daily")
def q_window_daily(spark, sf):
    return WC.window_daily(D.window_report(spark, sf, "current"))


@query("window_current")
def q_window_current(spark, sf):
    return window_current_df(spark, sf)


@query("window_finished")
def q_window_finished(spark, sf):
    return window_finished_df(spark, sf)


@query("window_all")
def q_window_all(spark, sf):
    return window_table_df.direct(spark, sf)


# --- gauges ------------------------------------------------------------------------------------

from fishladder.operators import gauges as G  # noqa: E402


@shared
def gauge_year_df(spark, sf) -> DataFrame:
    return G.gauge_year(D.gauge_daily_raw(spark, sf), D.gauge_sites(spark), D.AS_OF_EVENTS)


@query("gauge_year")
def q_gauge_year(spark, sf):
    return gauge_year_df(spark, sf)


@query("gauge_latest")
def q_gauge_latest(spark, sf):
    return G.latest_reading(gauge_year_df(spark, sf))


# --- chunks and data-quality tallies -----------------------------------------------------------------

from fishladder.operators import chunks as C  # noqa: E402


@query("tag_chunks")
def q_tag_chunks(spark, sf):
    return C.tag_chunks(marks_table_v(spark, sf))


@query("qa_release_sites")
def q_qa_release_sites(spark, sf):
    return S.tally(marks_v(spark, sf), ["release_site", "release_date"])


@query("qa_life_stage")
def q_qa_life_stage(spark, sf):
    return S.tally(marks_v(spark, sf), ["mark_lifestage"])


@query("qa_release_tally")
def q_qa_release_tally(spark, sf):
    return R.release_tally(marks_v(spark, sf))


@query("qa_inseason_release")
def q_qa_inseason_release(spark, sf):
    return S.tally(inseason_travel_df(spark, sf), ["species", "hatchery", "release_sitecode", "release_date"])


# --- dashboard ------------------------------------------------------------------------------------

from fishladder.plans import dashboard as B  # noqa: E402

HATCH = D.HATCHERY_ROLES
ADULT_FIRST_YEAR = 1999


def own(species):
    return B.juvenile_selection(species, hatchery=HATCH["DWOR"])


@shared
def juveniles_df(spark, sf, species="Chinook") -> DataFrame:
    return B.juveniles(inseason_travel_df(spark, sf), species, hatchery=HATCH["DWOR"])


@stored
def arrivals_df(spark, sf, species, dam) -> DataFrame:
    """Counted arrivals behind the timing panels of a species and a dam."""
    return B.arrivals(inseason_travel_at(spark, sf, [dam]), species, dam, own(species))


@shared
def adult_bind_df(spark, sf) -> DataFrame:
    complete = P.season_dense(adult_complete_df(spark, sf), L.species_max_dates_df(spark), "max_date")
    inseason = P.season_dense(adult_inseason_df(spark, sf), P.inseason_max_dates(spark, D.AS_OF), "inseason_max")
    return B.adult_bind(complete, inseason, ADULT_FIRST_YEAR)


@shared
def adults_sel(spark, sf) -> DataFrame:
    return B.adults(adult_bind_df(spark, sf), "Lower Granite", "Steelhead", (1999, 2002))


@shared
def adults_sel_undensified(spark, sf) -> DataFrame:
    """The B5 selection before gap filling. Filled days only add zero counts
    and copies of the running/season totals, so maxima of running totals,
    the season totals they carry and sums of daily counts are the same as on
    the filled table."""
    both = adult_complete_df(spark, sf).unionByName(adult_inseason_df(spark, sf))
    return B.adults(both.where(F.col("spawn_year") >= ADULT_FIRST_YEAR), "Lower Granite", "Steelhead", (1999, 2002))


@shared
def window_sel(spark, sf) -> DataFrame:
    return B.window_selection(WC.dashboard_window(window_table_df(spark, sf)), 1999, "Summer Chinook",
                              "Lower Granite")


def _rounded_density(df: DataFrame) -> DataFrame:
    """x (epoch days) and density (per day) to 6 decimals: sums of floating
    terms depend on summation order, their rounded values do not."""
    return df.withColumns({"x": F.round("x", 6), "density": F.round("density", 6)})


@query("group_kde")
def q_group_kde(spark, sf):
    return _rounded_density(B.density_of_arrivals(arrivals_df(spark, sf, "Steelhead", "LGR")))


@query("timing_summary")
def q_timing_summary(spark, sf):
    return B.timing_of_arrivals(arrivals_df(spark, sf, "Chinook", "LGR"))


@query("b01")
def q_b01(spark, sf):
    return juveniles_df(spark, sf, "Chinook")


@query("b01_steelhead")
def q_b01_steelhead(spark, sf):
    return juveniles_df(spark, sf, "Steelhead")


@query("b02")
def q_b02(spark, sf):
    return B.tag_count(juveniles_df(spark, sf, "Chinook"), HATCH["DWOR"])


@query("b03")
def q_b03(spark, sf):
    return _rounded_density(B.density_of_arrivals(arrivals_df(spark, sf, "Chinook", "LGR")))


@query("b04")
def q_b04(spark, sf):
    return _rounded_density(B.density_of_arrivals(arrivals_df(spark, sf, "Chinook", "BONN")))


@query("b04_lines")
def q_b04_lines(spark, sf):
    return B.timing_of_arrivals(arrivals_df(spark, sf, "Chinook", "BONN"))


@query("b05")
def q_b05(spark, sf):
    return adults_sel(spark, sf)


@query("b06")
def q_b06(spark, sf):
    names = {role: L.HATCHERY_NAMES[code] for code, role in HATCH.items()}
    return B.adult_ytd(adults_sel_undensified(spark, sf), "Steelhead", D.AS_OF, list(HATCH.values()), names)


@query("b07")
def q_b07(spark, sf):
    return B.adult_last_week(adults_sel_undensified(spark, sf), "Steelhead", D.AS_OF, list(HATCH.values()))


@query("b08")
def q_b08(spark, sf):
    return B.adult_daily_series(adults_sel(spark, sf))


@query("b09")
def q_b09(spark, sf):
    return B.adult_cumulative_series(adults_sel(spark, sf), D.AS_OF)


@query("b10")
def q_b10(spark, sf):
    return window_sel(spark, sf)


@query("b11")
def q_b11(spark, sf):
    return B.window_ytd(window_sel(spark, sf))


@query("b12")
def q_b12(spark, sf):
    return B.window_last_week(window_sel(spark, sf), D.AS_OF)


@query("b13")
def q_b13(spark, sf):
    return B.window_daily_series(window_sel(spark, sf), L.window_plot_limits_df(spark))


@query("b14")
def q_b14(spark, sf):
    return B.window_cumulative_series(window_sel(spark, sf), L.window_plot_limits_df(spark), D.AS_OF)


def comparison_df(spark, sf, species, years) -> DataFrame:
    """The selection looks at summary keys only, so it is applied to the
    counts and the medians of other species and years are never computed."""
    sel = B.comparison_selection(species, years)
    both = S.emigration_all(S.summary_of_counts(history_counts(spark, sf).where(sel)),
                            S.summary_of_counts(inseason_counts(spark, sf).where(sel)))
    return B.emigration_comparison(both, species, years)


@query("b15")
def q_b15(spark, sf):
    return comparison_df(spark, sf, "Chinook", (1997, 2001))


@query("b16")
def q_b16(spark, sf):
    return B.comparison_series(comparison_df(spark, sf, "Steelhead", (1997, 2001)))


@query("b17")
def q_b17(spark, sf):
    return B.gauge_panel(gauge_year_df(spark, sf), "Clearwater (Peck)")


@query("b18")
def q_b18(spark, sf):
    return B.gauge_series(gauge_year_df(spark, sf), "Clearwater (Peck)")


@query("b19")
def q_b19(spark, sf):
    # The panel needs only year ranges. Densifying adds days inside existing
    # (species, hatchery, spawn year, dam) groups and every summary group comes
    # from an input row, so the ranges of the passage tables and of the counted
    # histories equal those of the densified and summarised tables; the medians
    # and the gap filling are not needed for this panel.
    adults = (adult_complete_df(spark, sf).unionByName(adult_inseason_df(spark, sf))
              .where(F.col("spawn_year") >= ADULT_FIRST_YEAR))
    years = (history_counts(spark, sf).select("release_year")
             .unionByName(inseason_counts(spark, sf).select("release_year")))
    return B.control_limits(adults, WC.dashboard_window(window_table_df(spark, sf)), years,
                            gauge_year_df(spark, sf), D.AS_OF)
