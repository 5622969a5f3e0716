"""Daily merge: new detections into the hand-off tables, without a rebuild.

The rebuild (``plans.refresh``) reads every landed file again. Here only the
rows landed since the last run are read. First detections are minima, so the
first of old firsts and new rows is the first of everything; every table of one
row per tag changes only for the tags with new detections, and only the
partitions such tags lie in are written again (``sinks.update_partitions``).
The result equals the rebuild over all files so far.

    merge_reports    in-season: first_detections, travel, emigration_all
    merge_histories  history job: daily_detections, juv_history,
                     adult_detections, emigration_history, emigration_all

The passage and dense tables count tags per day; the refresh job makes them
from ``daily_detections``.

A step that is repeated after a failure changes nothing: minima of the same
rows are the same. All tables must have been written by the refresh job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fishladder.operators import history as H
from fishladder.operators import passage as P
from fishladder.operators import summaries as S
from fishladder.sources import lookups as L
from fishladder.sources.readers import read_snapshot
from fishladder.sources.sinks import current_number, update_partitions, write_snapshot
from fishladder.sources.subtables import scratch_table

def _partition_values(df: DataFrame, col: str) -> list:
    """The partition values that occur (years: a handful)."""
    return [r[0] for r in df.select(col).distinct().collect()]


def _in(col: str, values) -> Column:
    known = [v for v in values if v is not None]
    hit = F.col(col).isin(known) if known else F.lit(False)
    return F.coalesce(hit, F.lit(False)) | (F.col(col).isNull() if None in values else F.lit(False))


def replace_tags(old: DataFrame, new: DataFrame, tags: DataFrame, partition_by: str, path: str) -> list:
    """Rows of ``tags`` in the table ``old`` replaced by ``new``: only partitions
    that lose or get a row of those tags are read and written. Returns them."""
    gone = old.join(tags, "pit_id", "left_semi").select(partition_by)
    values = _partition_values(gone.unionByName(new.select(partition_by)), partition_by)
    if not values:
        return []
    kept = old.where(_in(partition_by, values)).join(tags, "pit_id", "left_anti")
    merged = kept.unionByName(new)
    update_partitions(merged, path, partition_by, only_changed=True, covers=values)
    return values


def merge_histories(spark: SparkSession, root: str, new_detections: DataFrame, dam_key: DataFrame,
                    drop_spawn_year: int) -> dict:
    """New tag-history detections (typed as the refresh job's ``tag_history``)
    into the history tables. Returns what was written: table -> partitions."""
    root, done = root.rstrip("/"), {}
    table = lambda name: read_snapshot(spark, f"{root}/{name}")
    marks, daily, juv, adults = (table(n) for n in ("marks", "daily_detections", "juv_history", "adult_detections"))

    new_first = scratch_table(spark, "new-first", H.first_per_site_day(new_detections))
    tags = scratch_table(spark, "new-tags", new_first.select("pit_id").where("pit_id IS NOT NULL").distinct())
    years = _partition_values(new_first, "obs_year")
    if not years:
        return {n: [] for n in ("daily_detections", "juv_history", "adult_detections", "emigration_history")}
    old = daily.where(_in("obs_year", years)).select(*new_first.columns)
    merged = scratch_table(spark, "merged-first", H.first_per_site_day(old.unionByName(new_first)))
    update_partitions(merged.select(*daily.columns), f"{root}/daily_detections", "obs_year", only_changed=True)
    done["daily_detections"] = sorted(years, key=str)

    # everything known about the tags that changed: few rows beside the tables
    daily = table("daily_detections")
    own = scratch_table(spark, "own-detections", daily.join(tags, "pit_id", "left_semi"))
    own_marks = scratch_table(spark, "own-marks", marks.join(tags, "pit_id", "left_semi"))
    history = H.juvenile_history(own_marks, H.attach_dams(own, dam_key, "obs_sitecode"))
    written = scratch_table(spark, "own-history", history)
    done["juv_history"] = replace_tags(juv, written.select(*juv.columns), tags, "release_year", f"{root}/juv_history")

    adult = P.complete_filter(drop_spawn_year)(P.adult_detections(own, own_marks, L.ADULT_OBS_TYPES))
    adult = scratch_table(spark, "own-adults", adult)
    done["adult_detections"] = replace_tags(adults, adult.select(*adults.columns), tags, "spawn_year", f"{root}/adult_detections")

    # summaries of the release years whose histories changed
    values, juv = done["juv_history"], table("juv_history")
    summary, seen = table("emigration_history"), current_number(spark, f"{root}/emigration_history")
    fresh = S.emigration_summary(juv.where(_in("release_year", values)))
    write_snapshot(summary.where(~_in("release_year", values)).unionByName(fresh), f"{root}/emigration_history", expect=seen)
    done["emigration_history"] = values
    _write_comparison(spark, root)
    return done


def _write_comparison(spark: SparkSession, root: str) -> None:
    """``emigration_all`` from the summaries and the travel table: a few rows per release group."""
    at = current_number(spark, f"{root}/emigration_all")
    both = S.emigration_all(read_snapshot(spark, f"{root}/emigration_history"),
                            S.emigration_summary(read_snapshot(spark, f"{root}/travel")))
    write_snapshot(both, f"{root}/emigration_all", expect=at)


def merge_reports(spark: SparkSession, root: str, new_reports: DataFrame, new_upstream: DataFrame, marks_current: DataFrame,
                  dam_key: DataFrame, upstream: DataFrame, release_dates=None) -> int:
    """New in-season report rows (and new tags of the upstream report) into
    ``first_detections`` and ``travel``. ``upstream`` is the whole upstream
    report so far. Returns the number of tags that were worked out again."""
    root = root.rstrip("/")
    first, travel = (read_snapshot(spark, f"{root}/{n}") for n in ("first_detections", "travel"))
    first_at, travel_at = (current_number(spark, f"{root}/{n}") for n in ("first_detections", "travel"))
    new = scratch_table(spark, "new-site-first", H.first_per_site(new_reports))
    tags = scratch_table(spark, "new-tags", new.select("pit_id").unionByName(new_upstream.select("pit_id"))
                         .where("pit_id IS NOT NULL").distinct())
    merged = H.first_per_site(first.unionByName(new.select(*first.columns)))
    write_snapshot(merged.select(*first.columns), f"{root}/first_detections", bucket_by="pit_id", expect=first_at)

    first = read_snapshot(spark, f"{root}/first_detections")
    own = H.inseason_travel(marks_current.join(tags, "pit_id", "left_semi"), first.join(tags, "pit_id", "left_semi"),
                            dam_key, upstream.join(tags, "pit_id", "left_semi"), release_dates=release_dates)
    kept = travel.join(tags, "pit_id", "left_anti")
    write_snapshot(kept.unionByName(own.select(*travel.columns)), f"{root}/travel", expect=travel_at)
    _write_comparison(spark, root)
    return tags.count()
