"""Adult returns: seasonal calendar, passage events and daily counts.

Raw detections are reduced per tag by map-side-combined aggregations
(day-first, then last per tag-year); the daily table that follows is bounded
by dams x species x hatcheries x spawn years x 366 days, so its windows
(running totals, gap filling) are cheap at any input size.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fishladder.functions.dates import SeasonRule, adult_calendar, ocean_age, spawn_year_of
from fishladder.operators.verbs import carry_forward, densify_dates, last_by, running_totals
from fishladder.sources import lookups as L
from fishladder.sources.lookups import literal_df

ADULT_DAILY_KEYS = ["spawn_year", "species", "hatchery"]
DENSE_KEYS = ["species", "hatchery", "spawn_year", "dam"]


def _with_marks(det: DataFrame, marks: DataFrame) -> DataFrame:
    m = marks.select(F.col("pit_id").alias("_pid"), "hatchery", "species", "release_date",
                     "release_group", "mark_lifestage")
    return det.join(m, F.col("pit_id") == F.col("_pid"), "left").drop("_pid")


def with_calendar(df: DataFrame) -> DataFrame:
    """D18 columns: day_of_year, dummy_date, spawn_year, ocean_age."""
    dummy, spawn = adult_calendar("species", "obs_datetime")
    out = df.withColumns({"day_of_year": F.dayofyear("obs_datetime"), "dummy_date": dummy, "spawn_year": spawn})
    return out.withColumn("ocean_age", ocean_age("species", "spawn_year", "release_year"))


def adult_detections(det: DataFrame, marks: DataFrame, obs_types=None) -> DataFrame:
    """D14 + D18: detections at >= 1 year at large with calendar columns.

    ``det`` needs pit_id, obs_datetime, obs_sitecode (+ obs_type when
    ``obs_types`` is given). Detections of unknown tags drop out at the
    years-at-large filter.
    """
    d = det if obs_types is None else det.where(F.col("obs_type").isin(list(obs_types)))
    j = _with_marks(d, marks)
    j = (j.withColumns({"obs_year": F.year("obs_datetime"), "release_year": F.year("release_date"),
                        "years_at_large": F.year("obs_datetime") - F.year("release_date")})
          .where(F.col("years_at_large") > 0))
    return with_calendar(j)


def inseason_adult_detections(report: DataFrame, marks: DataFrame) -> DataFrame:
    """In-season adult report: Coho and unknown species rows dropped first."""
    r = report.where(F.col("report_species") != "Coho").drop("report_species")
    return adult_detections(r, marks)


def passage_events(adults: DataFrame, sites, per_site: bool,
                   kelt_group: str = L.KELT_GROUP) -> DataFrame:
    """The last detection per tag and year (and site when ``per_site``)
    at the given sites; kelts and tags without a release group excluded."""
    a = adults.where(F.col("obs_sitecode").isin(list(sites)) & (F.col("release_group") != kelt_group))
    keys = ["pit_id", "obs_year"] + (["obs_sitecode"] if per_site else [])
    return last_by(a, keys, ["obs_datetime"], ["dummy_date", "spawn_year", "species", "hatchery"])


def daily_passage(events: DataFrame) -> DataFrame:
    """Daily count per (day, spawn year, species, hatchery) with running
    and season totals (computed before any season filter)."""
    daily = events.groupBy("dummy_date", *ADULT_DAILY_KEYS).agg(F.count(F.lit(1)).alias("daily_total"))
    return running_totals(daily, ADULT_DAILY_KEYS, ["dummy_date"], "daily_total")


def current_spawn_years(as_of: dt.date) -> dict:
    """Spawn year in progress per species at ``as_of`` (month switch)."""
    return {s: spawn_year_of(s, as_of, SeasonRule.MONTH) for s in ("Chinook", "Steelhead")}


def inseason_filter(daily: DataFrame, as_of: dt.date) -> DataFrame:
    """D22 in-season: keep each species' spawn year in progress."""
    sy = current_spawn_years(as_of)
    cond = None
    for sp, y in sy.items():
        c = (F.col("species") == sp) & (F.col("spawn_year") == y)
        cond = c if cond is None else cond | c
    return daily.where(cond)


def complete_filter(drop_spawn_year: int):
    """D22 history: drop the one spawn year that is not finished."""
    return lambda df: df.where(F.col("spawn_year") != drop_spawn_year)


def inseason_max_dates(spark, as_of: dt.date, species=None) -> DataFrame:
    """As-of season end on the dummy calendar (Q6: day of year without -1)."""
    species = L.ADULT_SPECIES if species is None else species
    y = as_of - dt.timedelta(days=1)
    doy = y.timetuple().tm_yday
    rows = []
    for sp in species:
        origin = L.SPRING_ORIGIN if (sp == "Steelhead" and y.month < 7) else L.AUTUMN_ORIGIN
        rows.append((sp, origin + dt.timedelta(days=doy)))
    return literal_df(spark, rows, "species string, inseason_max date")


def season_dense(daily: DataFrame, limits: DataFrame, limit_col: str, keys=None) -> DataFrame:
    """Every day from the group's first day to its season limit; missing
    days count 0, running and season totals carried down.

    ``limits`` is a literal/as-of table (species[, dam] -> limit), broadcast.
    """
    keys = DENSE_KEYS if keys is None else keys
    join_keys = [c for c in limits.columns if c != limit_col]
    d = daily.join(F.broadcast(limits), join_keys, "left")
    dense = densify_dates(d, keys, "dummy_date", limit_col).drop(limit_col)
    dense = dense.withColumn("daily_total", F.coalesce("daily_total", F.lit(0).cast("long")))
    out = carry_forward(dense, keys, ["dummy_date"], ["running_total", "annual_total"])
    return out.select(*keys, "dummy_date", "daily_total", "running_total", "annual_total")


def passage_tables_reduced(det: DataFrame, marks: DataFrame, sites_by_dam: dict, per_site_by_dam: dict,
                           season_filter, obs_types=None, kelt_group: str = L.KELT_GROUP) -> DataFrame:
    """D20-D23 for all dams in one pass, detections reduced before the join.

    Every filter between the raw rows and the "last detection" pick is
    either per row (site, event type) or per tag-year (years at large,
    release group), so the pick commutes with them. Detections at passage
    sites are tagged with their dam (literal site table, broadcast) and
    reduced to the last one per (dam, tag, year[, site]) by one
    map-side-combined aggregation; only those rows meet the marks table.
    All dams share the scan, the reduction, the join and the daily windows.
    """
    spark = det.sparkSession
    site_dam = literal_df(spark, 
        [(site, dam, bool(per_site_by_dam[dam])) for dam, sites in sites_by_dam.items() for site in sites],
        "obs_sitecode string, dam string, _per_site boolean")
    d = det if obs_types is None else det.where(F.col("obs_type").isin(list(obs_types)))
    d = (d.join(F.broadcast(site_dam), "obs_sitecode")
          .withColumns({"obs_year": F.year("obs_datetime"),
                        "_site_key": F.when(F.col("_per_site"), F.col("obs_sitecode"))}))
    ev = last_by(d, ["dam", "pit_id", "obs_year", "_site_key"], ["obs_datetime"], [])
    m = marks.select(F.col("pit_id").alias("_pid"), "hatchery", "species", "release_date", "release_group")
    j = (ev.join(m, F.col("pit_id") == F.col("_pid"), "inner").drop("_pid")
           .where((F.col("obs_year") - F.year("release_date") > 0) & (F.col("release_group") != kelt_group)))
    dummy, spawn = adult_calendar("species", "obs_datetime")
    j = j.withColumns({"dummy_date": dummy, "spawn_year": spawn})
    daily = j.groupBy("dam", "dummy_date", *ADULT_DAILY_KEYS).agg(F.count(F.lit(1)).alias("daily_total"))
    daily = running_totals(daily, ["dam"] + ADULT_DAILY_KEYS, ["dummy_date"], "daily_total")
    return season_filter(daily).select("dummy_date", "spawn_year", "species", "hatchery",
                                       "daily_total", "running_total", "annual_total", "dam")
