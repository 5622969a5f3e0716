"""Mark-file normalisation, release order and release-group classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fishladder.functions.dates import mdy
from fishladder.functions.text import word
from fishladder.sources import lookups as L
from fishladder.sources.subtables import scratch_table

MARK_COLUMNS = ["pit_id", "hatchery", "mark_date", "release_site", "release_sitecode",
                "release_date", "mark_lifestage", "species", "length_mm", "tag_file"]
MARKS_TABLE_COLUMNS = MARK_COLUMNS + ["release_year", "release_group"]


def normalize_marks(raw: DataFrame) -> DataFrame:
    """Parse the two m/d/y dates, hatchery and release site code are the
    first words of the site names; rename to the hand-off schema."""
    return raw.select(
        F.col("Tag Code").alias("pit_id"),
        word("Mark Site Name", 1).alias("hatchery"),
        mdy("Mark Date MMDDYYYY").alias("mark_date"),
        F.col("Release Site Name").alias("release_site"),
        word("Release Site Name", 1).alias("release_sitecode"),
        mdy("Release Date MMDDYYYY").alias("release_date"),
        F.col("Mark Life Stage Value").alias("mark_lifestage"),
        F.col("Species Name").alias("species"),
        F.col("Length mm").alias("length_mm"),
        F.col("Mark File Name").alias("tag_file"),
    )


RELEASE_KEYS = ["hatchery", "species", "release_sitecode"]


def release_tally(marks: DataFrame) -> DataFrame:
    """Tags per (hatchery, species, site, release date) with the release
    order of that date inside its (hatchery, species, site, year).

    The tally is one row per release event, so the window below runs on a
    table of release events, not on tags.
    """
    tally = (marks.groupBy(*RELEASE_KEYS, "release_date").agg(F.count(F.lit(1)).alias("n"))
                  .withColumn("release_year", F.year("release_date")))
    w = Window.partitionBy(*RELEASE_KEYS, "release_year").orderBy(
        F.col("release_date").asc_nulls_last())
    return tally.withColumn("release_order", F.row_number().over(w))


# Release events up to which the tally is broadcast, and copies of it beyond.
TALLY_ROWS, TALLY_SALTS = 1_000_000, 32


def release_order(marks: DataFrame, tally_rows: int = TALLY_ROWS, tally: DataFrame | None = None) -> DataFrame:
    """Attach release_year and release_order to every mark.

    ``tally`` is the written ``release_tally`` of the same marks where the caller
    keeps one; else it (one row per release event) is written to the shared
    folder. Its size is looked up there: up to ``tally_rows`` events it is broadcast, so
    marks are not shuffled at all; a larger one is joined in copies by a salt
    of the tag, so an event that holds most tags is dealt over many tasks. The
    join matches NULL keys with NULL (N5).
    """
    on = RELEASE_KEYS + ["release_date"]
    if tally is None:
        tally = scratch_table(marks.sparkSession, "release-tally", release_tally(marks))
    t = tally.select(*[F.col(k).alias("_t_" + k) for k in on], "release_year", "release_order")
    cond = [F.col(k).eqNullSafe(F.col("_t_" + k)) for k in on]
    if t.count() <= tally_rows:
        t = F.broadcast(t)
    else:
        marks = marks.withColumn("_salt", F.pmod(F.xxhash64("pit_id"), F.lit(TALLY_SALTS)).cast("int"))
        t = t.withColumn("_t_salt", F.explode(F.sequence(F.lit(0), F.lit(TALLY_SALTS - 1))))
        cond.append(F.col("_salt") == F.col("_t_salt"))
    return marks.join(t, cond, "left").drop("_salt", "_t_salt", *["_t_" + k for k in on])


def release_group_expr(rules=None, single_year: int = L.SINGLE_RELEASE_YEAR) -> Column:
    """D11 rule chain: first matching rule wins, no match -> NULL."""
    rules = L.RELEASE_GROUP_RULES if rules is None else rules
    expr = None
    for site, species, single, order, label in rules:
        cond = F.col("release_sitecode") == site
        if species is not None:
            cond = cond & (F.col("species") == species)
        if single is True:
            cond = cond & (F.col("release_year") == single_year)
        elif single is False:
            cond = cond & ~(F.col("release_year") == single_year)
        if order is not None:
            cond = cond & (F.col("release_order") == order)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def classify_release_groups(marks: DataFrame, rules=None,
                            single_year: int = L.SINGLE_RELEASE_YEAR, tally: DataFrame | None = None) -> DataFrame:
    """D10 + D11: marks -> the 12-column marks hand-off table."""
    m = release_order(marks, tally=tally)
    m = m.withColumn("release_group", release_group_expr(rules, single_year).cast("string"))
    return m.select(*MARKS_TABLE_COLUMNS)


def release_group_dated_expr(dates: dict | None = None, rules=None,
                             date_col: str = "release_date") -> Column:
    """D12 in-season rule chain with fixed early/late release dates."""
    rules = L.RELEASE_GROUP_RULES_DATED if rules is None else rules
    dates = L.RELEASE_DATES_INSEASON if dates is None else dates
    d = F.to_date(F.col(date_col))
    expr = None
    for site, when_date, label in rules:
        cond = F.col("release_sitecode") == site
        if when_date is not None:
            cond = cond & (d == F.lit(dates[when_date]))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.cast("string")
