"""Date/time parsing, calendars and travel-time arithmetic.

All functions return Columns; none of them leaves the JVM.
"""

from __future__ import annotations

import datetime as dt
from enum import Enum

from pyspark.sql import Column
from pyspark.sql import functions as F

from fishladder.sources import lookups as L
from fishladder.sources.subtables import scratch_table


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _lit_date(d) -> Column:
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(d))


def mdy(col) -> Column:
    """m/d/y text -> date; padded or unpadded; bad text -> NULL."""
    return F.try_to_date(_c(col), "M/d/yyyy")


def mdy_hms(col) -> Column:
    """m/d/y h:m:s text (12- or 24-hour) -> timestamp; bad text -> NULL."""
    c = _c(col)
    return F.coalesce(F.try_to_timestamp(c, F.lit("M/d/yyyy h:mm:ss a")),
                      F.try_to_timestamp(c, F.lit("M/d/yyyy H:mm:ss")))


# Layouts of a column that mixes year-first, month-first and day-first dates.
_ORDER_FORMATS = {"ymd": "yyyy-M-d", "mdy": "M/d/yyyy", "dmy": "d/M/yyyy"}


def parse_mixed_date(col, orders=("ymd", "mdy", "dmy")) -> Column:
    """One value on its own: the first order that parses wins."""
    c = F.trim(_c(col).cast("string"))
    return F.coalesce(*[F.try_to_date(c, _ORDER_FORMATS[o]) for o in orders])


def date_order_counts(df, col: str, keys, orders=("ymd", "mdy", "dmy")):
    """How many values of ``col`` each order parses, per ``keys``: a row per file."""
    text = F.trim(F.col(col).cast("string"))
    return df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        *[F.count(F.try_to_date(text, _ORDER_FORMATS[o])).alias(f"_n{i}") for i, o in enumerate(orders)])


# Files up to which their date orders are broadcast.
ORDER_ROWS = 1_000_000


def parse_mixed_date_by(df, col: str, keys, orders=("ymd", "mdy", "dmy"), counts=None, order_rows: int = ORDER_ROWS):
    """``df`` with text column ``col`` parsed to dates, the order chosen per
    ``keys`` (e.g. the file): the order that parses most of a file's values is
    tried first, ties in the order given, values it cannot parse go on to the
    next. So 3/4 in a file that also has 25/4 is the 3rd of April.

    ``counts`` is the written ``date_order_counts`` table of the same rows where
    the caller keeps one. It has a row per file and is broadcast after its rows
    were counted, so no row is moved; beyond ``order_rows`` files it is joined.
    """
    text = F.trim(F.col(col).cast("string"))
    attempts = [F.try_to_date(text, _ORDER_FORMATS[o]) for o in orders]
    if counts is None:
        counts = scratch_table(df.sparkSession, "date-orders", date_order_counts(df, col, keys, orders))
    if counts.count() <= order_rows:
        counts = F.broadcast(counts)
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    tried = F.array_sort(F.array(*[F.struct((-F.col(f"_n{i}")).alias("n"), F.lit(i).alias("i"), a.alias("d"))
                                   for i, a in enumerate(attempts)]))
    best = F.get(F.filter(tried, lambda x: x["d"].isNotNull()), F.lit(0))["d"]
    out = df.join(counts, on, "left")
    return out.select(*[best.alias(c) if c == col else F.col(f"`{c}`") for c in df.columns])


def days_from(origin, n) -> Column:
    """origin + n days (R's as.Date(n, origin=...))."""
    return F.date_add(_lit_date(origin), _c(n).cast("int"))


class SeasonRule(Enum):
    """When a Steelhead season turns over. The program uses three switches,
    each in its own place; they differ on 1 July of common years."""

    DAY_OF_YEAR = "from day 183 of the year"
    MONTH = "from July on"
    FIRST_OF_JULY = "from 1 July on"


def season_switched(d, rule: SeasonRule):
    """True once the next season has begun on ``d`` (a date, or a date Column)."""
    if isinstance(d, dt.date):
        doy, month, july = d.timetuple().tm_yday, d.month, d >= dt.date(d.year, 7, 1)
    else:
        doy, month, july = F.dayofyear(d), F.month(d), d >= july_first(d)
    return {SeasonRule.DAY_OF_YEAR: doy >= L.SEASON_SWITCH_DOY, SeasonRule.MONTH: month >= 7,
            SeasonRule.FIRST_OF_JULY: july}[rule]


def spawn_year_of(species: str, d: dt.date, rule: SeasonRule, steelhead: str = "Steelhead") -> int:
    """Spawn year in progress for a species on a day."""
    return d.year + 1 if species == steelhead and season_switched(d, rule) else d.year


def adult_calendar(species, ts, steelhead: str = "Steelhead", rule: SeasonRule = SeasonRule.DAY_OF_YEAR):
    """Day-of-year season calendar for adult detections.

    Returns (dummy_date, spawn_year). Steelhead seen before the switch
    map to spring (1977 origin, offset = day of year), everything else to the
    1976 origin with offset day-of-year - 1; Steelhead from the switch day on
    spawn the following year.
    """
    doy = F.dayofyear(_c(ts))
    yr = F.year(_c(ts))
    is_sthd = _c(species) == steelhead
    switched = season_switched(_c(ts), rule)
    dummy = (F.when(is_sthd & ~switched, days_from(L.SPRING_ORIGIN, doy))
             .otherwise(days_from(L.AUTUMN_ORIGIN, doy - 1)))
    spawn = F.when(is_sthd & switched, yr + 1).otherwise(yr)
    return dummy, spawn


def ocean_age(species, spawn_year, release_year, steelhead: str = "Steelhead") -> Column:
    base = _c(spawn_year) - _c(release_year)
    return F.when(_c(species) == steelhead, base - 1).otherwise(base)


def remap_year(d, year: int) -> Column:
    """Same month and day in ``year``; 29 Feb into a common year -> NULL."""
    return F.try_to_date(F.concat(F.lit(f"{year:04d}-"), F.date_format(_c(d), "MM-dd")),
                         "yyyy-MM-dd")


def july_first(d) -> Column:
    return F.make_date(F.year(_c(d)), F.lit(7), F.lit(1))


def window_calendar(species, d, steelhead: str = "Steelhead"):
    """Month-day season calendar for window counts: (july_first, dummy_date, spawn_year)."""
    jf = july_first(d)
    is_sthd = _c(species) == steelhead
    switched = season_switched(_c(d), SeasonRule.FIRST_OF_JULY)
    dummy = (F.when(is_sthd & ~switched, remap_year(d, 1977))
             .otherwise(remap_year(d, 1976)))
    spawn = F.when(is_sthd & switched, F.year(_c(d)) + 1).otherwise(F.year(_c(d)))
    return jf, dummy, spawn


def micros(ts) -> Column:
    """Microseconds since 1970 of a timestamp with or without time zone."""
    return F.unix_micros(_c(ts).cast("timestamp"))


def epoch_seconds(ts) -> Column:
    """Seconds since 1970 as double, fractions kept."""
    return micros(ts) / F.lit(1_000_000.0)


def travel_days(ts, release_ts) -> Column:
    """Whole days from release to detection: floor((t - r) / 86400), may be negative."""
    return F.floor((epoch_seconds(ts) - epoch_seconds(release_ts)) / F.lit(86400.0))


def month_day_label(d) -> Column:
    """'April 05'."""
    return F.date_format(_c(d), "MMMM dd")


def to_fahrenheit(c) -> Column:
    return _c(c) * F.lit(9.0) / F.lit(5.0) + F.lit(32.0)
