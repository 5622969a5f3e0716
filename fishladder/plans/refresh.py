"""Refresh job: build every hand-off table and write the table catalogue.

Inputs come either from landed files (``inputs_from_files``) or from the
benchmark driver tables (``inputs_from_driver``); both produce the same
normalised DataFrames, and ``build_catalog`` turns them into the tables the
dashboard reads. Tables are written with ``write_snapshot`` (a new version,
then the switch) under ``out_root``; marks and daily detections are written first and read
back, which cuts the lineage that every later table shares (a written table
in the shared folder, so lost executors never force a recompute from raw).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fishladder.functions import mdy_hms, word
from fishladder.operators import history as H
from fishladder.operators import passage as P
from fishladder.operators import releases as R
from fishladder.operators import summaries as S
from fishladder.operators import window_counts as WC
from fishladder.operators.chunks import tag_chunks, write_chunk_files, write_chunks
from fishladder.operators.gauges import gauge_year
from fishladder.sources import lookups as L
from fishladder.sources import readers
from fishladder.operators.verbs import union_all
from fishladder.sources.sinks import write_snapshot
from fishladder.sources.subtables import drop_subtables


@dataclass
class Inputs:
    marks_history: DataFrame          # normalised marks (D1 schema), release years of the history
    marks_current: DataFrame          # normalised marks of the current release year
    tag_history: DataFrame            # normalised tag-history detections (D2 history schema)
    reports: DataFrame                # in-season detection report rows: pit_id, obs_datetime, site, sitecode
    upstream: DataFrame               # pit_id column of the upstream report
    adult_report: DataFrame           # pit_id, obs_sitecode, obs_datetime, report_species
    window_current: DataFrame         # wide window reports, current layout
    window_finished: DataFrame        # wide window reports, finished layout
    gauge_raw: DataFrame              # site_no, Date, X_00010_00003, X_00060_00003
    dam_key: DataFrame                # site -> dam for the history job
    dam_key_inseason: DataFrame       # the in-season job's shorter site list
    gauge_sites: DataFrame
    passage_sites: dict = field(default_factory=lambda: dict(L.PASSAGE_SITES))
    single_year: int = L.SINGLE_RELEASE_YEAR
    release_dates: dict = field(default_factory=lambda: dict(L.RELEASE_DATES_INSEASON))
    drop_spawn_year: int | None = None
    as_of: dt.date = field(default_factory=dt.date.today)
    gauge_as_of: dt.date | None = None
    problems: DataFrame | None = None  # rejected cells per file and column of the landed files


def inputs_from_files(spark: SparkSession, paths: dict, as_of: dt.date, **params) -> Inputs:
    """``paths`` keys: marks_history, marks_current, tag_history_dir, reports (list),
    upstream, adult_report, window_current (list), window_finished (list), gauges (list)."""
    rep = union_all(*[H.normalize_report(readers.read_detection_report(spark, p))
                              for p in paths["reports"]])
    adult = readers.read_detection_report(spark, paths["adult_report"])
    adult = adult.select(F.col("Tag").alias("pit_id"), word("Site", 1).alias("obs_sitecode"),
                         mdy_hms("Obs Time").alias("obs_datetime"),
                         F.col("Species Name").alias("report_species"))
    problems = union_all(*[readers.mark_problems(spark, paths[p]) for p in ("marks_history", "marks_current")],
                         *[readers.window_problems(spark, paths[p]) for p in ("window_current", "window_finished")],
                         readers.gauge_problems(spark, paths["gauges"]), readers.tag_history_problems(spark, paths["tag_history_dir"]))
    up = readers.read_detection_report(spark, paths["upstream"]).select(F.col("Tag").alias("pit_id"))
    return Inputs(
        marks_history=R.normalize_marks(readers.read_mark_file(spark, paths["marks_history"])),
        marks_current=R.normalize_marks(readers.read_mark_file(spark, paths["marks_current"])),
        tag_history=H.normalize_tag_history(readers.read_tag_histories(spark, paths["tag_history_dir"])),
        reports=rep, upstream=up, adult_report=adult,
        window_current=readers.read_window_reports(spark, paths["window_current"]),
        window_finished=readers.read_window_reports(spark, paths["window_finished"]),
        gauge_raw=readers.read_gauge_daily(spark, paths["gauges"]),
        dam_key=L.dam_key_df(spark), dam_key_inseason=L.dam_key_df(spark, L.DAM_KEY_INSEASON),
        gauge_sites=L.gauge_sites_df(spark), as_of=as_of, problems=problems, **params)


def inputs_from_driver(spark: SparkSession, sf_dir: str) -> Inputs:
    from fishladder.sources import driver as D
    return Inputs(
        marks_history=D.marks(spark, sf_dir), marks_current=D.marks(spark, sf_dir),
        tag_history=D.detections(spark, sf_dir), reports=D.report(spark, sf_dir),
        upstream=D.upstream_tags(spark, sf_dir), adult_report=D.adult_report(spark, sf_dir),
        window_current=D.window_report(spark, sf_dir, "current"),
        window_finished=D.window_report(spark, sf_dir, "finished"),
        gauge_raw=D.gauge_daily_raw(spark, sf_dir), dam_key=D.dam_key(spark), dam_key_inseason=D.dam_key(spark),
        gauge_sites=D.gauge_sites(spark),
        passage_sites=D.PASSAGE_SITES, single_year=D.SINGLE_YEAR, release_dates=D.RELEASE_DATES,
        drop_spawn_year=D.HISTORY_DROP_SPAWN_YEAR, as_of=D.AS_OF, gauge_as_of=D.AS_OF_EVENTS)


def build_catalog(spark: SparkSession, inp: Inputs, out_root: str, chunk_dir: str | None = None,
                  chunk_files: str | None = None) -> dict:
    """Write all hand-off tables; returns {table name: folder of the version written}.

    ``chunk_dir``: the tag ids also as a folder per chunk; ``chunk_files``: as one
    plain file per chunk in one folder."""
    root = out_root.rstrip("/")
    paths = {}

    def save(name, df, partition_by=None, bucket_by=None):
        paths[name] = write_snapshot(df, f"{root}/{name}", partition_by, bucket_by)
        return readers.read_snapshot(spark, f"{root}/{name}")

    if inp.problems is not None:
        save("reader_problems", inp.problems.coalesce(1))       # a row per file and column
    # marks and day-first detections: written once, read back (lineage cut), bucketed by the tag they are joined on
    tally = save("release_tally", R.release_tally(inp.marks_history))
    marks = save("marks", R.classify_release_groups(inp.marks_history, single_year=inp.single_year, tally=tally),
                 "release_year", bucket_by="pit_id")
    types = save("event_types", H.event_types(inp.tag_history))
    day_first = save("daily_detections", H.first_per_site_day(inp.tag_history, types), "obs_year", bucket_by="pit_id")
    if chunk_dir:
        write_chunks(tag_chunks(marks), chunk_dir)
    if chunk_files:
        write_chunk_files(marks, chunk_files)

    det_dams = H.attach_dams(day_first, inp.dam_key, "obs_sitecode")
    juv = save("juv_history", H.juvenile_history(marks, det_dams, by_tag=True), "release_year")
    hist_summary = save("emigration_history", S.emigration_summary(juv))

    first = save("first_detections", H.first_per_site(inp.reports), bucket_by="pit_id")
    travel = save("travel", H.inseason_travel(inp.marks_current, first, inp.dam_key_inseason,
                                              inp.upstream, release_dates=inp.release_dates))
    save("emigration_all", S.emigration_all(hist_summary, S.emigration_summary(travel)))

    drop = inp.drop_spawn_year if inp.drop_spawn_year is not None else inp.as_of.year
    finished = P.complete_filter(drop)          # the season that is not over stays out of the saved table
    save("adult_detections", finished(P.adult_detections(day_first, marks, L.ADULT_OBS_TYPES)), "spawn_year")
    per_site = {d: L.PASSAGE_PER_SITE.get(d, True) for d in inp.passage_sites}
    complete = save("adult_complete", P.passage_tables_reduced(day_first, marks, inp.passage_sites, per_site,
                                                               finished, obs_types=L.ADULT_OBS_TYPES))
    rep = inp.adult_report.where(F.col("report_species") != "Coho")
    inseason = save("adult_inseason", P.passage_tables_reduced(rep, marks, inp.passage_sites, per_site,
                                                               lambda df: P.inseason_filter(df, inp.as_of)))
    save("adult_complete_dense", P.season_dense(complete, L.species_max_dates_df(spark), "max_date"))
    save("adult_inseason_dense", P.season_dense(inseason, P.inseason_max_dates(spark, inp.as_of), "inseason_max"))

    cur = WC.window_current(WC.window_daily(inp.window_current), inp.as_of)
    fin = WC.window_finished(WC.window_daily(inp.window_finished, L.WINDOW_COLUMNS_FINISHED), inp.as_of)
    fin = save("window_counts_complete", fin, "spawn_year")
    save("window_daily", WC.window_table(cur, fin), "spawn_year")

    save("water", gauge_year(inp.gauge_raw, inp.gauge_sites, inp.gauge_as_of or inp.as_of))
    return paths


def main(argv=None) -> None:
    """``spark-submit run_refresh.py --out <shared folder> (--sf-dir DIR | --inputs FILE.json)``

    ``--inputs`` names a JSON file with the landed-file paths of
    ``inputs_from_files`` and ``as_of`` (YYYY-MM-DD).
    """
    import argparse
    import json

    from fishladder.session import build_session, input_bytes, size_for_input

    ap = argparse.ArgumentParser(description="Build the hand-off table catalogue.")
    ap.add_argument("--out", required=True)
    ap.add_argument("--sf-dir")
    ap.add_argument("--inputs")
    ap.add_argument("--chunks")
    ap.add_argument("--chunk-files")
    args = ap.parse_args(argv)
    spark = build_session()
    if args.sf_dir:
        size_for_input(spark, input_bytes(spark, args.sf_dir))
        inp = inputs_from_driver(spark, args.sf_dir)
    else:
        spec = json.load(open(args.inputs))
        as_of = dt.date.fromisoformat(spec.pop("as_of"))
        files = [v for k, v in spec.items() if isinstance(v, str)] + \
                [x for v in spec.values() if isinstance(v, list) for x in v]
        size_for_input(spark, input_bytes(spark, files))
        inp = inputs_from_files(spark, spec, as_of)
    try:
        for name, path in build_catalog(spark, inp, args.out, chunk_dir=args.chunks, chunk_files=args.chunk_files).items():
            print(f"{name}\t{path}")
    finally:
        drop_subtables(spark)


if __name__ == "__main__":
    main()
