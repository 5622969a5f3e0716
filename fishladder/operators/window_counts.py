"""Dam window counts: wide daily reports -> long, classified, calendared,
with running totals per season.

The report tables are small by nature (days x dams), but nothing here
assumes it: the unpivot is a narrow transformation, and the only windows
partition by (season, dam, species, stage, origin) with one row per day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fishladder.functions.dates import SeasonRule, spawn_year_of, window_calendar
from fishladder.functions.text import str_c, word
from fishladder.operators.verbs import filter_not_in, running_totals, union_all
from fishladder.sources import lookups as L
from fishladder.sources.lookups import literal_df

RUNNING_KEYS = ["spawn_year", "dam", "species", "life_stage", "origin"]


def window_long(report: DataFrame, columns=None) -> DataFrame:
    """Unpivot the count columns (NULL counts kept) and classify.

    The rewrites are sequential (N17): life stage and origin are read from
    the column name before the species name is rewritten; Chinook gets its
    run prefix last (unknown run -> NULL species, Q15).
    """
    columns = L.WINDOW_COLUMNS_CURRENT if columns is None else columns
    base = (report.where(F.col("Date").isNotNull())
                  .select(F.col("Project").alias("dam"), F.col("Date").cast("date").alias("date"),
                          F.year("Date").alias("year"), F.col("Chinook Run").alias("run_type"),
                          F.col("TempC").cast("double").alias("temp"),
                          *[F.col(src).cast("double").alias(name) for src, name in columns]))
    long = base.unpivot(["dam", "date", "year", "run_type", "temp"], [n for _, n in columns],
                        "species", "count")
    sp = F.col("species")
    run = F.col("run_type")
    run_name = None
    for code, name in L.CHINOOK_RUNS:
        run_name = F.when(run == code, name) if run_name is None else run_name.when(run == code, name)
    # step 1 reads the original column name and run code (life stage and
    # origin come from the name before it is rewritten, N17) ...
    long = long.withColumns({
        "life_stage": F.when(sp.isin("Jack_Chinook", "Jack_Coho"), "Jack")
                       .when(sp.isin("Chinook", "Coho"), "Adult").otherwise("All"),
        "origin": F.when(sp == "Wild_Steelhead", "Wild").otherwise("All"),
        "species": F.when(sp.isin("Wild_Steelhead", "Jack_Chinook", "Jack_Coho"), word(sp, 2, "_")).otherwise(sp),
        "run_type": run_name,
    })
    # ... step 2 prefixes Chinook with the rewritten run name
    long = long.withColumn("species", F.when(F.col("species") == "Chinook",
                                             str_c(F.col("run_type"), F.col("species"), sep=" "))
                           .otherwise(F.col("species")))
    return long


def with_window_calendar(df: DataFrame) -> DataFrame:
    """july_first, dummy_date (29 Feb Steelhead -> NULL), spawn_year."""
    jf, dummy, spawn = window_calendar("species", "date")
    return df.withColumns({"july_first": jf, "dummy_date": dummy, "spawn_year": spawn})


def window_running(df: DataFrame) -> DataFrame:
    """NULL count -> 0, running and season totals per
    (spawn year, dam, species, life stage, origin) by dummy date (NULL last)."""
    return running_totals(df, RUNNING_KEYS,
                          [F.col("dummy_date").asc_nulls_last(), F.col("date").asc_nulls_last()],
                          "count", fill_null=True)


def window_daily(report: DataFrame, columns=None) -> DataFrame:
    return window_running(with_window_calendar(window_long(report, columns)))


def current_spawn_years_df(spark, as_of: dt.date, species=None) -> DataFrame:
    """Per species, the spawn year in progress (day-of-year switch)."""
    species = L.WINDOW_SPECIES if species is None else species
    rows = [(s, spawn_year_of(s, as_of, SeasonRule.DAY_OF_YEAR)) for s in species]
    return literal_df(spark, rows, "species string, spawn_year int")


def window_current(daily: DataFrame, as_of: dt.date, species=None) -> DataFrame:
    """D27 current: rows of each species' season in progress (inner join on
    species and spawn year with a literal table, broadcast)."""
    cur = current_spawn_years_df(daily.sparkSession, as_of, species)
    return daily.join(F.broadcast(cur), ["species", "spawn_year"], "inner")


def window_finished(daily: DataFrame, as_of: dt.date) -> DataFrame:
    """D27 finished: calendar years before the as-of year, plus this year's
    Steelhead rows before the row's own 1 July (Q36)."""
    y = F.year("date")
    return daily.where((y < as_of.year) |
                       ((F.col("species") == "Steelhead") & (y == as_of.year) & (F.col("date") < F.col("july_first"))))


WINDOW_COLUMNS = ["dam", "date", "year", "run_type", "temp", "species", "count", "life_stage", "origin",
                  "july_first", "dummy_date", "spawn_year", "running_total", "annual_total"]


WINDOW_KEY = ["dam", "date", "species", "life_stage", "origin"]


def window_table(current: DataFrame, finished: DataFrame, dedupe: bool = False) -> DataFrame:
    """Current season rows followed by finished seasons (UNION ALL, Q12).

    The two sources can both hold last autumn's Steelhead rows. By default
    both are kept, as the program does; ``dedupe=True`` keeps one row per
    (dam, date, species, life stage, origin), preferring the current source
    (a map-side-combined pick, not a window)."""
    u = union_all(current.select(*WINDOW_COLUMNS).withColumn("_src", F.lit(0)),
                  finished.select(*WINDOW_COLUMNS).withColumn("_src", F.lit(1)))
    if not dedupe:
        return u.drop("_src")
    rest = [c for c in WINDOW_COLUMNS if c not in WINDOW_KEY]
    from fishladder.operators.verbs import first_by
    return first_by(u, WINDOW_KEY, ["_src"], rest).drop("_src").select(*WINDOW_COLUMNS)


def window_duplicates(table: DataFrame) -> DataFrame:
    """Data check for Q12: keys present more than once in the window table."""
    return (table.groupBy(*WINDOW_KEY).agg(F.count(F.lit(1)).alias("n"))
                 .where(F.col("n") > 1))


def dashboard_window(table: DataFrame) -> DataFrame:
    """Rows the dashboard shows: no wild Steelhead subset (N4), no jacks."""
    return table.where(~((F.col("species") == "Steelhead") & (F.col("origin") == "Wild"))
                       & (F.col("life_stage") != "Jack"))


__all__ = ["window_long", "with_window_calendar", "window_running", "window_daily", "window_current",
           "window_finished", "window_table", "dashboard_window", "current_spawn_years_df",
           "filter_not_in"]
