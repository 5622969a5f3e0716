"""Detections -> first events -> wide capture histories with travel times.

Plan shape at scale: raw detections are reduced by map-side-combined
aggregations (first per key, conditional min per dam) *before* the single
shuffle join with the marks table on ``pit_id``. Site->dam lookups are
literal tables (<= 26 rows) and always broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fishladder.functions.dates import epoch_seconds, mdy_hms, micros, travel_days
from fishladder.functions.text import word
from fishladder.operators.verbs import first_by, last_by
from fishladder.session import input_bytes
from fishladder.sources import lookups as L
from fishladder.sources.subtables import scratch_table


# --- normalisation (D2) --------------------------------------------------------

def normalize_report(raw: DataFrame) -> DataFrame:
    """In-season detection report: Tag, Site, Obs Time -> pit_id, obs_datetime, site, sitecode."""
    return raw.select(F.col("Tag").alias("pit_id"),
                      mdy_hms("Obs Time").alias("obs_datetime"),
                      F.col("Site").alias("site"),
                      word("Site", 1).alias("sitecode"))


def normalize_tag_history(raw: DataFrame) -> DataFrame:
    """Complete tag histories: drop mark events, lower-case the event type,
    parse the time and derive date and year."""
    ts = mdy_hms("Event Date Time Value")
    return (raw.where(F.col("Event Type Name") != "Mark")
               .select(F.col("Tag Code").alias("pit_id"),
                       F.lower("Event Type Name").alias("obs_type"),
                       ts.alias("obs_datetime"),
                       F.to_date(ts).alias("obs_date"),
                       F.year(F.to_date(ts)).alias("obs_year"),
                       F.col("Event Site Code Value").alias("obs_sitecode")))


# --- first events (D4, D5) -------------------------------------------------------

def first_per_site(det: DataFrame) -> DataFrame:
    """First detection per (tag, site, sitecode)."""
    return first_by(det, ["pit_id", "site", "sitecode"], ["obs_datetime"], [])


# Event types up to which the first detections are packed into numbers.
EVENT_TYPES = 10_000


def event_types(det: DataFrame) -> DataFrame:
    """The event types that occur, whatever they are, numbered from 1 in their
    order: obs_type, code. One column is read, equal types combine map-side."""
    types = det.select("obs_type").where(F.col("obs_type").isNotNull()).distinct()
    return types.withColumn("code", F.row_number().over(Window.orderBy("obs_type")).cast("long"))


def first_per_site_day(det: DataFrame, types: DataFrame | None = None, max_types: int = EVENT_TYPES) -> DataFrame:
    """First detection per (tag, day, site) - collapses antenna noise; of
    equal times the one with the smallest event type (none before all others).

    Time and type travel as one number: microseconds since the start of the
    day, times the number of types, plus the type's code. The smallest number is
    the first time with the smallest type, and a plain ``min`` of a long is a
    hash aggregation, combined map-side without a sort. ``types`` is the written
    ``event_types`` table of the same detections where the caller keeps one; it
    is broadcast after its rows were counted. Beyond ``max_types`` types the
    pair is carried as it is (a sort aggregation).

    ``obs_year`` is a function of the key (the day) and is derived after.
    """
    keys = ["pit_id", "obs_date", "obs_sitecode"]
    if types is None:
        types = scratch_table(det.sparkSession, "event-types", event_types(det))
    n = types.count() + 1
    if n > max_types:
        first = first_by(det, keys, ["obs_datetime"], ["obs_type"])
        return first.withColumn("obs_year", F.year("obs_date"))
    coded = det.where(F.col("obs_datetime").isNotNull()).join(
        F.broadcast(types.select(F.col("obs_type").alias("_type"), F.col("code").alias("_code"))),
        F.col("obs_type") == F.col("_type"), "left")
    day = F.unix_micros(F.coalesce("obs_date", F.lit("1970-01-01").cast("date")).cast("timestamp"))
    packed = (micros("obs_datetime") - day) * F.lit(n).cast("long") + F.coalesce("_code", F.lit(0).cast("long"))
    first = coded.groupBy(*keys).agg(F.min(packed).alias("_first"))
    first = first.withColumn("_code", F.pmod("_first", F.lit(n).cast("long")))
    at = F.timestamp_micros(F.expr(f"(_first - _code) div {n}L") + day).cast(det.schema["obs_datetime"].dataType)
    out = first.join(F.broadcast(types.select("obs_type", F.col("code").alias("_code"))), "_code", "left")
    return out.select(*keys, at.alias("obs_datetime"), "obs_type", F.year("obs_date").alias("obs_year"))


def last_per(det: DataFrame, keys) -> DataFrame:
    """Last detection per key (passage event)."""
    return last_by(det, keys, ["obs_datetime"])


# --- dams (D6, D7, J7) -------------------------------------------------------------

def attach_dams(det: DataFrame, dam_key: DataFrame, site_col: str) -> DataFrame:
    """Left lookup of dam and dam code; unknown sites keep NULL codes."""
    k = dam_key.select(F.col("sitecode").alias("_site"), "dam", "dam_code")
    return det.join(F.broadcast(k), det[site_col] == F.col("_site"), "left").drop("_site")


def first_per_dam(det_dams: DataFrame) -> DataFrame:
    """D6 long form: first detection per (tag, dam code), NULL code included."""
    return (det_dams.groupBy("pit_id", "dam_code")
                    .agg(F.min("obs_datetime").alias("first_detection")))


def dam_grid(long: DataFrame, levels=None) -> DataFrame:
    """Every observed tag x every dam level (+ the NULL level when some
    site was unmapped), missing combinations with NULL first_detection.

    One conditional ``min`` per level makes a wide row per tag, which is then
    stacked into (level, time) pairs over the literal level list.
    """
    levels = L.DAM_LEVELS if levels is None else levels
    # one-row flag: does any detection sit at an unmapped site?
    flag = long.agg(F.max(F.col("dam_code").isNull().cast("int")).alias("_has_null")).withColumn("_k", F.lit(1))
    at = {c: F.min(F.when(F.col("dam_code") == c, F.col("first_detection"))).alias(f"_{i}") for i, c in enumerate(levels)}
    wide = long.groupBy("pit_id").agg(
        *at.values(), F.min(F.when(F.col("dam_code").isNull(), F.col("first_detection"))).alias("_none"))
    cells = [F.struct(F.lit(c).alias("dam_code"), F.col(f"_{i}").alias("first_detection")) for i, c in enumerate(levels)]
    unmapped = F.struct(F.lit(None).cast("string").alias("dam_code"), F.col("_none").alias("first_detection"))
    stacked = F.when(F.col("_has_null") == 1, F.array(*cells, unmapped)).otherwise(F.array(*cells))
    return (wide.withColumn("_k", F.lit(1)).join(F.broadcast(flag), "_k")
                .select("pit_id", F.explode(stacked).alias("_cell")).select("pit_id", "_cell.*"))


def wide_first_detections(det_dams: DataFrame, keys=("pit_id",), levels=None,
                          ts: str = "obs_datetime") -> DataFrame:
    """One row per ``keys``, one first-detection column per dam level.

    A conditional ``min`` per level is a single hash aggregation with
    map-side partial combine (no pivot value scan, no second aggregation).
    """
    levels = L.DAM_LEVELS if levels is None else levels
    return det_dams.groupBy(*keys).agg(
        *[F.min(F.when(F.col("dam_code") == c, F.col(ts))).alias(c) for c in levels])


# --- flags and travel (D8, D9) -----------------------------------------------------

def capture_flags(df: DataFrame, levels=None) -> DataFrame:
    levels = L.DAM_LEVELS if levels is None else levels
    return df.withColumns({f"{c}_ch": F.when(F.col(c).isNull(), F.lit("0")).otherwise(F.lit("1"))
                           for c in levels})


def travel_times(df: DataFrame, levels=None, release_ts: str = "release_ts") -> DataFrame:
    """release_time and <dam>_time as epoch seconds; <dam>_traveltime in whole days."""
    levels = L.DAM_LEVELS if levels is None else levels
    cols = {"release_time": epoch_seconds(release_ts)}
    cols.update({f"{c}_time": epoch_seconds(c) for c in levels})
    cols.update({f"{c.lower()}_traveltime": travel_days(c, release_ts) for c in levels})
    return df.withColumns(cols)


def history_columns(levels=None, release_group: bool = True) -> list[str]:
    levels = L.DAM_LEVELS if levels is None else levels
    ids = ["pit_id", "species", "tag_file", "hatchery", "release_date", "release_year",
           "mark_date", "release_sitecode"] + (["release_group"] if release_group else []) + ["length_mm"]
    return (ids + list(levels) + [f"{c}_ch" for c in levels] + ["release_time"]
            + [f"{c}_time" for c in levels] + [f"{c.lower()}_traveltime" for c in levels])


# --- full histories (D15, in-season travel) ----------------------------------------------

def juvenile_history(marks: DataFrame, det_dams: DataFrame, levels=None, by_tag: bool = False) -> DataFrame:
    """One row per mark. Juvenile marks detected at a known dam in their
    release year get first-detection times; every other mark keeps NULL times
    and "0" flags (Q8).

    Detections are first reduced to (tag, year) x dams by a partially
    combined aggregation, then joined once to the marks on (tag, year).
    ``by_tag``: both tables are bucketed by the tag, so the tag alone is the join
    key (the year is compared beside it) and nothing is shuffled.
    """
    levels = L.DAM_LEVELS if levels is None else levels
    wide = wide_first_detections(det_dams.where(F.col("dam_code").isin(list(levels))),
                                 keys=("pit_id", "obs_year"), levels=levels)
    wide = wide.withColumnRenamed("pit_id", "_pid")
    in_year = F.col("release_year") - F.col("obs_year") == 0 if by_tag else F.col("release_year") == F.col("obs_year")
    cond = (F.col("pit_id") == F.col("_pid")) & in_year & (F.col("mark_lifestage") == "Juvenile")
    j = marks.join(wide, cond, "left").drop("_pid", "obs_year")
    j = j.withColumn("release_ts", F.col("release_date").cast("timestamp"))
    j = travel_times(capture_flags(j, levels), levels)
    return j.select(*history_columns(levels))


def detections_long(det_first_site: DataFrame, dam_key: DataFrame) -> DataFrame:
    """In-season D6: first per site -> dams -> first per (tag, dam)."""
    return first_per_dam(attach_dams(det_first_site, dam_key, "sitecode"))


def inseason_travel(marks: DataFrame, det_first_site: DataFrame, dam_key: DataFrame,
                    upstream_tags: DataFrame, levels=None, release_dates=None,
                    onsite_codes=None, year_guard: bool = False,
                    upstream_before_release: bool = False) -> DataFrame:
    """In-season travel table: marks (all kept) + first detection per dam,
    flags, travel days, upstream contradiction removal (D13) and dated
    release groups (D12).

    ``year_guard`` (Q21): the in-season job counts detections of any year
    (default, as the program does); True keeps only detections in the
    release year, like the history job. ``upstream_before_release`` (Q31):
    see ``exclude_upstream``.
    """
    from fishladder.operators.releases import release_group_dated_expr
    levels = L.DAM_LEVELS if levels is None else levels
    # a site outside the wanted dams fills no column; the site is a key of the first detections,
    # so Spark drops such rows below that aggregation
    sites = dam_key.where(F.col("dam_code").isin(list(levels))).select("sitecode")
    det_dams = attach_dams(det_first_site.join(F.broadcast(sites), "sitecode", "left_semi"), dam_key, "sitecode")
    keys = ("pit_id", "_obs_year") if year_guard else ("pit_id",)
    if year_guard:
        det_dams = det_dams.withColumn("_obs_year", F.year("obs_datetime"))
    wide = wide_first_detections(det_dams, keys=keys, levels=levels).withColumnRenamed("pit_id", "_pid")
    m = marks.withColumn("release_year", F.year("release_date"))
    cond = F.col("pit_id") == F.col("_pid")
    if year_guard:
        cond = cond & (F.col("release_year") == F.col("_obs_year"))
    j = m.join(wide, cond, "left").drop("_pid", "_obs_year")
    j = j.withColumn("release_date", F.col("release_date").cast("timestamp"))
    j = travel_times(capture_flags(j, levels), levels, release_ts="release_date")
    j = exclude_upstream(j, marks, upstream_tags, onsite_codes, before_release=upstream_before_release)
    j = j.withColumn("release_group", release_group_dated_expr(release_dates))
    return j.select(*history_columns(levels))


# Upstream tags (rows, and bytes of their written table) up to which they are broadcast.
UPSTREAM_ROWS, UPSTREAM_BYTES = 1_000_000, 32 << 20


def exclude_upstream(df: DataFrame, marks: DataFrame, upstream_tags: DataFrame,
                     onsite_codes=None, before_release: bool = False, broadcast_rows: int = UPSTREAM_ROWS) -> DataFrame:
    """Drop tags released on station that also appear in the upstream
    report. Default is presence only, as the program does (Q31); with
    ``before_release`` only tags seen upstream before their release day are
    dropped (``upstream_tags`` then needs ``obs_datetime``).

    The upstream report is small beside the marks: its tags are written to the
    shared folder, one row each, and broadcast if that table is within the
    limits, so neither the marks nor ``df`` are shuffled for this step. A larger
    report is joined by shuffles; Spark's own run-time Bloom filter of the report
    then thins the marks before they are moved, where its size check allows.
    """
    onsite_codes = L.ONSITE_RELEASE_CODES if onsite_codes is None else onsite_codes
    onsite = marks.where(F.col("release_sitecode").isin(onsite_codes)).select("pit_id", "release_date")
    seen = F.min("obs_datetime") if before_release else F.lit(None)
    tags = scratch_table(df.sparkSession, "upstream-tags", upstream_tags.where(F.col("pit_id").isNotNull())
                         .groupBy("pit_id").agg(seen.cast("timestamp").alias("_first_up")))
    few = tags.count() <= broadcast_rows and input_bytes(df.sparkSession, tags.inputFiles()) <= UPSTREAM_BYTES
    near = F.broadcast if few else (lambda t: t)
    if before_release:
        flagged = (onsite.join(near(tags), "pit_id")
                         .where(F.col("_first_up") < F.col("release_date").cast("timestamp")).select("pit_id"))
    else:
        flagged = onsite.select("pit_id").join(near(tags.select("pit_id")), "pit_id", "left_semi")
    # a tag marked more than once is one row here, so this side is no larger than the upstream table
    return df.join(near(flagged.distinct()), "pit_id", "left_anti")
