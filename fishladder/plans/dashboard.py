"""Parameterised dashboard queries (the data behind every panel).

Each function takes the hand-off tables as DataFrames plus the panel's
inputs and returns a DataFrame; nothing is collected. Scalars the panels
derive from data (maxima, axis limits, current seasons) stay inside the
plan as one-row aggregates joined back (broadcast), never driver values.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fishladder.functions.dates import SeasonRule, micros, month_day_label, season_switched, to_fahrenheit
from fishladder.functions.text import comma, str_c
from fishladder.operators.density import group_kde
from fishladder.operators.gauges import latest_reading
from fishladder.operators.quantiles import quantiles_of_counts
from fishladder.operators.summaries import DAY_MICROS
from fishladder.operators.verbs import filter_not_in, join_null_safe, last_by, union_all
from fishladder.operators.window_counts import current_spawn_years_df
from fishladder.sources import lookups as L


def _one_row_join(df: DataFrame, one: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row (broadcast)."""
    return df.withColumn("_k1", F.lit(1)).join(F.broadcast(one.withColumn("_k1", F.lit(1))), "_k1").drop("_k1")


# --- juvenile emigration (B1-B4, D30, D29) -------------------------------------------

def juvenile_selection(species: str, hatchery: str = "DWOR", chinook_groups=None):
    """B1 as a condition on the travel table."""
    groups = L.DASHBOARD_CHINOOK_GROUPS if chinook_groups is None else chinook_groups
    own = F.col("hatchery") == hatchery if species == "Steelhead" else F.col("release_group").isin(list(groups))
    return (F.col("species") == species) & own


def juveniles(travel: DataFrame, species: str, hatchery: str = "DWOR",
              chinook_groups=None) -> DataFrame:
    """B1: Steelhead -> one hatchery; otherwise the named release groups."""
    return travel.where(juvenile_selection(species, hatchery, chinook_groups))


def tag_count(juv: DataFrame, hatchery: str = "DWOR") -> DataFrame:
    """B2: selected species and number of tags of one hatchery."""
    one = juv.agg(F.min("species").alias("selected_species"),
                  F.count(F.when(F.col("hatchery") == hatchery, 1)).alias("tag_count"))
    return one.withColumn("tag_label", str_c("Number Tagged: ", comma("tag_count")))


ARRIVAL_KEYS = ["hatchery", "release_group"]


def arrivals(travel: DataFrame, species: str, dam: str, selection) -> DataFrame:
    """Arrivals of a species at a dam, counted per hatchery x release group and
    time: everything the timing panels need, from one pass over the travel
    table. ``_own``: rows of the panel's selection; the others only bound the axis."""
    return (travel.where((F.col("species") == species) & F.col(dam).isNotNull())
                  .groupBy(F.coalesce(selection, F.lit(False)).alias("_own"), *ARRIVAL_KEYS, micros(dam).alias("_us"))
                  .agg(F.count(F.lit(1)).alias("_c"), F.min("release_date").alias("_rel")))


def axis_limits(counted: DataFrame) -> DataFrame:
    """One row: xmin = first release - 2 days, xmax = latest arrival of the
    species + 7 days (A4, A8)."""
    return counted.agg(
        (F.min(F.when(F.col("_own"), F.col("_rel"))).cast("timestamp") - F.expr("INTERVAL 2 DAYS")).alias("xmin"),
        (F.timestamp_micros(F.max("_us")) + F.expr("INTERVAL 7 DAYS")).alias("xmax"))


def timing_summary(travel: DataFrame, species: str, dam: str = "LGR", selection=None) -> DataFrame:
    """``timing_of_arrivals`` of the travel table."""
    return timing_of_arrivals(arrivals(travel, species, dam, juvenile_selection(species) if selection is None else selection))


def timing_of_arrivals(counted: DataFrame) -> DataFrame:
    """D30 / B3-B4 lines: per hatchery x release group the median arrival,
    the first release date (Q18) and whole days between them; axis limits.
    The median comes from day buckets of the counted arrival times."""
    own = counted.where("_own").withColumnRenamed("_us", "_v")
    median = quantiles_of_counts(own.select(*ARRIVAL_KEYS, "_v", "_c"), ARRIVAL_KEYS, {"_m": 0.5}, width=DAY_MICROS)
    released = own.groupBy(*ARRIVAL_KEYS).agg(F.min("_rel").alias("release_date"))
    j = join_null_safe(released, median, ARRIVAL_KEYS).select(
        *ARRIVAL_KEYS, "release_date", F.timestamp_micros(F.floor("_m").cast("long")).alias("median_arrival"))
    j = j.withColumn("travel_days", F.floor(
        (micros("median_arrival") - micros(F.col("release_date").cast("timestamp"))) / 86_400_000_000.0))
    return _one_row_join(j, axis_limits(counted))


def arrival_density(travel: DataFrame, species: str, dam: str = "LGR", selection=None,
                    n_grid: int = 512, adjust: float = 0.5) -> DataFrame:
    """``density_of_arrivals`` of the travel table."""
    selection = juvenile_selection(species) if selection is None else selection
    return density_of_arrivals(arrivals(travel, species, dam, selection), n_grid, adjust)


def density_of_arrivals(counted: DataFrame, n_grid: int = 512, adjust: float = 0.5) -> DataFrame:
    """D29 / B3-B4 curves: density of arrival days per hatchery x group.

    ``counted`` (``arrivals``) is read several times: keep it as a written table
    where it is used again. x and density are in days (epoch days; density per day)."""
    lim = axis_limits(counted).select((micros("xmin") / 86_400_000_000.0).alias("lo"),
                                      (micros("xmax") / 86_400_000_000.0).alias("hi"))
    own = counted.where("_own").withColumn("_day", F.col("_us") / 86_400_000_000.0)
    return group_kde(own, ARRIVAL_KEYS, "_day", lim, n_grid, adjust, weight="_c")


# --- adults (B5-B9) ---------------------------------------------------------------------

def adult_bind(complete_dense: DataFrame, inseason_dense: DataFrame, first_year: int) -> DataFrame:
    return union_all(complete_dense, inseason_dense).where(F.col("spawn_year") >= first_year)


def adults(bound: DataFrame, dam: str, species: str, years: tuple) -> DataFrame:
    """B5."""
    return bound.where((F.col("dam") == dam) & (F.col("species") == species)
                       & (F.col("spawn_year") >= min(years)) & (F.col("spawn_year") <= max(years)))


def adult_current_sy(spark, as_of: dt.date) -> DataFrame:
    return current_spawn_years_df(spark, as_of, L.ADULT_SPECIES)


def adult_ytd(sel: DataFrame, species: str, as_of: dt.date, hatcheries, names: dict | None = None) -> DataFrame:
    """Per hatchery, the season total of the row with the largest
    running total in the species' current spawn year; the text shows the
    hatchery's name (``names``: code -> name)."""
    sy = adult_current_sy(sel.sparkSession, as_of).where(F.col("species") == species).select("spawn_year")
    cur = sel.join(F.broadcast(sy), "spawn_year", "left_semi").where(F.col("hatchery").isin(list(hatcheries)))
    top = last_by(cur, ["hatchery"], ["running_total"], ["annual_total", "dummy_date"])
    names = L.HATCHERY_NAMES if names is None else names
    shown = F.coalesce(*[F.when(F.col("hatchery") == code, name) for code, name in names.items()], F.col("hatchery"))
    return top.select("hatchery", "annual_total", str_c(shown, F.lit(": "), F.col("annual_total").cast("string")).alias("label"))


def _dummy_day(species: str, d: dt.date) -> dt.date:
    """The adult dummy-calendar day of a real date (same rule as D18)."""
    doy = d.timetuple().tm_yday
    if species == "Steelhead" and not season_switched(d, SeasonRule.DAY_OF_YEAR):
        return L.SPRING_ORIGIN + dt.timedelta(days=doy)
    return L.AUTUMN_ORIGIN + dt.timedelta(days=doy - 1)


def adult_last_week(sel: DataFrame, species: str, as_of: dt.date, hatcheries, mode: str = "doy") -> DataFrame:
    """Adults counted in the last 7 days.

    ``mode="doy"`` (default) compares days of year of the dummy dates with
    those of as-of - 7 days and as-of, as the dashboard does (Q7: empty in the
    first week of January, offsets of two calendars mixed). ``mode="date"``
    maps both ends onto the species' dummy calendar and compares dates.
    """
    sy = adult_current_sy(sel.sparkSession, as_of).where(F.col("species") == species).select("spawn_year")
    cur = sel.join(F.broadcast(sy), "spawn_year", "left_semi").where(F.col("hatchery").isin(list(hatcheries)))
    if mode == "doy":
        lw = (as_of - dt.timedelta(days=7)).timetuple().tm_yday
        today = as_of.timetuple().tm_yday
        cur = cur.where((F.dayofyear("dummy_date") >= lw) & (F.dayofyear("dummy_date") <= today))
    elif mode == "date":
        lo, hi = _dummy_day(species, as_of - dt.timedelta(days=7)), _dummy_day(species, as_of)
        cur = cur.where(F.col("dummy_date").between(F.lit(lo), F.lit(hi)))
    else:
        raise ValueError(f"mode must be 'doy' or 'date', not {mode!r}")
    return cur.groupBy("hatchery").agg(F.sum("daily_total").alias("new_count"))


def adult_daily_series(sel: DataFrame) -> DataFrame:
    """Daily bars per hatchery x spawn year with hover text."""
    return sel.select("hatchery", "spawn_year", "dummy_date", "daily_total",
                      str_c(" Date:", month_day_label("dummy_date"), "<br>", "Number Passed:",
                            F.col("daily_total").cast("string"), sep=" ").alias("label"))


def adult_cumulative_series(sel: DataFrame, as_of: dt.date) -> DataFrame:
    """Running totals labelled Current / Previous season."""
    sy = adult_current_sy(sel.sparkSession, as_of).withColumnRenamed("spawn_year", "_cur_sy")
    j = sel.join(F.broadcast(sy), "species", "left")
    return j.select("hatchery", "spawn_year", "dummy_date", "running_total",
                    F.when(F.col("spawn_year") == F.col("_cur_sy"), "Current").otherwise("Previous")
                    .alias("yr_category"))


# --- window counts (B10-B14) ------------------------------------------------------------

def window_selection(window: DataFrame, start_year: int, species: str, dam: str) -> DataFrame:
    """Seasons from ``start_year`` to the latest season of the table."""
    top = window.agg(F.max("spawn_year").alias("_max_sy"))
    sel = _one_row_join(window, top)
    return sel.where((F.col("spawn_year") >= start_year) & (F.col("spawn_year") <= F.col("_max_sy"))
                     & (F.col("species") == species) & (F.col("dam") == dam)).drop("_max_sy")


def window_ytd(sel: DataFrame) -> DataFrame:
    """Running total on the latest date (top-1, no global sort)."""
    top = last_by(sel.withColumn("_one", F.lit(1)), ["_one"], ["date"], ["dam", "running_total"]).drop("_one")
    return top.withColumn("label", F.concat(F.col("dam"), F.lit(": "), comma("running_total")))


def window_last_week(sel: DataFrame, as_of: dt.date) -> DataFrame:
    """Sum of counts over the last 7 days per dam."""
    since = as_of - dt.timedelta(days=7)
    return sel.where(F.col("date") >= F.lit(since)).groupBy("dam").agg(F.sum("count").alias("lw_total"))


def _clip(df: DataFrame, limits: DataFrame) -> DataFrame:
    j = df.join(F.broadcast(limits), ["dam", "species"], "left")
    return j.where((F.col("dummy_date") > F.col("min_date")) & (F.col("dummy_date") < F.col("max_date")))


def window_daily_series(sel: DataFrame, limits: DataFrame) -> DataFrame:
    """Latest season only, clipped to the (dam, species) plot limits."""
    top = sel.agg(F.max("spawn_year").alias("_max_sy"))
    latest = _one_row_join(sel, top).where(F.col("spawn_year") == F.col("_max_sy"))
    return _clip(latest, limits).select("dam", "species", "spawn_year", "date", "dummy_date", "count")


def window_cumulative_series(sel: DataFrame, limits: DataFrame, as_of: dt.date) -> DataFrame:
    """Clipped running totals labelled Current / Previous."""
    cur = current_spawn_years_df(sel.sparkSession, as_of).withColumnRenamed("spawn_year", "_cur_sy")
    j = _clip(sel, limits).join(F.broadcast(cur), "species", "left")
    return j.select("dam", "species", "spawn_year", "date", "dummy_date", "running_total",
                    F.when(F.col("spawn_year") == F.col("_cur_sy"), "Current").otherwise("Previous")
                    .alias("yr_category"))


# --- emigration comparison (B15-B16) -------------------------------------------------------

def comparison_selection(species: str, years: tuple):
    """B15 as a condition on the summary keys; it can be applied before the
    summaries are made, as it looks at keys only."""
    excl = L.COMPARISON_EXCLUDED["Chinook" if species == "Chinook" else "other"]
    return ((F.col("release_year") >= min(years)) & (F.col("release_year") <= max(years))
            & (F.col("species") == species) & filter_not_in("release_group", excl))


def emigration_comparison(summaries: DataFrame, species: str, years: tuple) -> DataFrame:
    """Summaries in the year range, without named groups (NULL kept)."""
    return summaries.where(comparison_selection(species, years))


def comparison_series(cmp: DataFrame, upper: str = "LGR", lower: str = "BONN") -> DataFrame:
    """Median travel days to both dams with their hover text."""
    def label(col, dam):
        return str_c(" Release Year:", F.col("release_year").cast("string"), "<br>", "Release Dates:",
                     F.col("earliest_release"), "-", F.col("latest_release"), "<br>",
                     f"Median Travel Time to {dam}:", F.col(col).cast("string"), "days", sep=" ")
    u, lw = f"median_{upper.lower()}", f"median_{lower.lower()}"
    return cmp.select("hatchery", "release_year", "release_group", u, lw,
                      label(u, upper).alias(f"{upper.lower()}_label"), label(lw, lower).alias(f"{lower.lower()}_label"))


# --- gauges (B17-B18) --------------------------------------------------------------------------

def gauge_panel(gauges: DataFrame, site_name: str) -> DataFrame:
    """Latest discharge and temperature (°C and °F) of one site."""
    last = latest_reading(gauges.where(F.col("name") == site_name))
    return last.select("name", "date", "mean_discharge", "mean_temp", "mean_temp_f",
                       F.concat(F.lit("Discharge: "), comma("mean_discharge"), F.lit(" CFS")).alias("discharge_label"))


def gauge_series(gauges: DataFrame, site_name: str) -> DataFrame:
    """Daily discharge and temperature series of one site."""
    return gauges.where(F.col("name") == site_name).select(
        "group", "date", "mean_discharge", "mean_temp", F.bround(to_fahrenheit("mean_temp"), 1).alias("mean_temp_f"))


# --- controls (B19) -----------------------------------------------------------------------------

def control_limits(bound_adults: DataFrame, window: DataFrame, summaries: DataFrame,
                   gauges: DataFrame, as_of: dt.date) -> DataFrame:
    """Slider ranges and defaults, one row."""
    a = bound_adults.agg(F.min("spawn_year").alias("adult_min_sy"), F.max("spawn_year").alias("adult_max_sy"))
    w = window.agg(F.min("spawn_year").alias("window_min_sy"), (F.max("spawn_year") - 1).alias("window_max_sy"),
                   (F.max("spawn_year") - 10).alias("window_default_sy"))
    s = summaries.agg(F.min("release_year").alias("release_min_year"),
                      F.max("release_year").alias("release_max_year"),
                      (F.max("release_year") - 5).alias("release_default_from"))
    # distinct site names: bounded by the gauge site list
    g = gauges.agg(F.array_join(F.array_sort(F.collect_set("name")), ", ").alias("gauge_sites"))
    doy = as_of.timetuple().tm_yday
    default_species = "Chinook" if 106 <= doy <= 212 else "Steelhead"
    out = _one_row_join(_one_row_join(_one_row_join(a, w), s), g)
    return out.withColumns({"default_adult_species": F.lit(default_species),
                            "min_date": F.lit(dt.date(as_of.year, 1, 1)),
                            "min_range_date": F.lit(dt.date(as_of.year, 3, 1))})


# --- start-up: the shared tables every panel reads ---------------------------------------

def load_app_tables(spark, catalog: dict, as_of: dt.date, first_adult_year: int) -> dict:
    """Read the hand-off snapshots written by the refresh job (``catalog``:
    table name -> path) and derive the tables the panels share: the bound
    adult table (gap-filled, from ``first_adult_year``), the window rows the
    dashboard shows, the per-species latest arrivals, gauges and summaries.
    Nothing is collected; every entry is a lazy DataFrame."""
    from fishladder.operators.passage import inseason_max_dates, season_dense
    from fishladder.operators.window_counts import dashboard_window

    read = {k: spark.read.parquet(v) for k, v in catalog.items()}
    complete = season_dense(read["adult_complete"], L.species_max_dates_df(spark), "max_date")
    inseason = season_dense(read["adult_inseason"], inseason_max_dates(spark, as_of), "inseason_max")
    travel = read["travel"]
    return {
        "water": read["water"],
        "emigration": travel,
        "emigration_max": travel.groupBy("species").agg(
            (F.max("LGR") + F.expr("INTERVAL 7 DAYS")).alias("LGR_max"),
            (F.max("BONN") + F.expr("INTERVAL 7 DAYS")).alias("BON_max")),
        "emigration_summaries": read["emigration_all"],
        "adults": adult_bind(complete, inseason, first_adult_year),
        "window": dashboard_window(read["window_daily"]),
        "latest_reading": latest_reading(read["water"]),
    }
