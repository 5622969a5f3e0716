"""Readers for the landed input files.

All readers go through ``spark.read`` so files are split and read in
parallel. The driver lists paths; header lines and line separators are read
by a Spark job over its text source (one small row per file comes back), so
many files do not queue up behind the driver and any path that Spark can read
will do.

A cell that its column's type does not take becomes NULL; ``problem_report``
counts such cells per file and column, ``rejected_cells`` lists them.
"""

from __future__ import annotations

import re
from collections import OrderedDict
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fishladder.functions.dates import mdy_hms, parse_mixed_date, parse_mixed_date_by
from fishladder.operators.verbs import union_all


# --- file-system helpers (Hadoop FS, so they work for any cluster store) ----------

def _fs_path(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def list_files(spark: SparkSession, path: str, suffix: str = ".csv") -> list[str]:
    """Files directly under ``path`` (or ``path`` itself) ending in ``suffix``, sorted."""
    p, fs = _fs_path(spark, path)
    if fs.getFileStatus(p).isFile():
        return [fs.makeQualified(p).toString()]
    out = [st.getPath().toString() for st in fs.listStatus(p)
           if st.isFile() and st.getPath().getName().lower().endswith(suffix)]
    return sorted(out)


@contextmanager
def settings(spark: SparkSession, values: dict):
    """Session settings for the time of a block."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# A scan in which every file is one task's own, whatever its size.
FILE_PER_TASK = {"spark.sql.files.maxPartitionBytes": str(1 << 60), "spark.sql.files.openCostInBytes": str(1 << 60)}


def _same_path(path: str) -> str:
    return re.sub("^file:/+", "file:/", path)


def file_heads(spark: SparkSession, files: list[str], encoding: str = "utf-8") -> list[tuple[str, str, str]]:
    """(path, header line, line separator) of every file, in the order given.

    The lines come from Spark's own text source, so any path Spark reads will do.
    Every file is one task, which stops after its first line (the line of the
    block that starts at 0). The separator is the one that ends the header line.
    """
    if not files:
        return []
    wide = encoding.lower().replace("_", "-").startswith("utf-16")
    with settings(spark, FILE_PER_TASK):
        lines = spark.read.text(files, lineSep="\n\x00" if wide else "\n")
        lines = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
                             F.col("value").cast("binary").alias("head"))
        alone = all(spark.conf.get(k) == v for k, v in FILE_PER_TASK.items())

        def first(batches):
            import pyarrow as pa
            seen = set()
            for b in batches:
                new = [i for i, (p, s) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
                       if s == 0 and p not in seen and not seen.add(p)]
                yield b.take(pa.array(new, pa.int64())).select(["path", "head"])
                if alone:
                    return
        found = {r["path"]: bytes(r["head"]) for r in lines.mapInArrow(first, "path string, head binary").collect()}  # a row per file
    heads = {_same_path(p): h for p, h in found.items()}
    heads = {**{unquote(p): h for p, h in heads.items()}, **heads}          # the source escapes special characters
    out = []
    for f in files:
        line = heads.get(_same_path(f), b"").decode(encoding, errors="replace").lstrip("\ufeff")
        out.append((f, line.rstrip("\r"), "\r\n" if line.endswith("\r") else "\n"))
    return out


# --- S1: UTF-16LE detection reports ------------------------------------------------

def read_utf16_report(spark: SparkSession, path: str) -> DataFrame:
    """Delimited UTF-16LE report (with or without BOM, LF or CRLF), all
    columns as strings. The line separator is the one that ends the header
    line, because a wrong one silently yields wrong rows; files stack by
    column name."""
    groups: OrderedDict[tuple, list[str]] = OrderedDict()
    for f, head, sep in file_heads(spark, list_files(spark, path), "utf-16-le"):
        groups.setdefault((head, sep), []).append(f)
    parts = []
    for (_, sep), files in groups.items():
        df = spark.read.options(header=True, encoding="UTF-16LE", lineSep=sep, inferSchema=False).csv(files)
        parts.append(df.toDF(*[c.lstrip("\ufeff") for c in df.columns]))
    return union_all(*parts)


def read_detection_report(spark: SparkSession, path: str) -> DataFrame:
    """Tag, Site, Obs Time (+ any other columns) of an in-season report."""
    return read_utf16_report(spark, path)


# --- S2/S3: UTF-8 CSV ----------------------------------------------------------------

def read_csv_strings(spark: SparkSession, path, **opts) -> DataFrame:
    """Header CSV(s) with every column read as text (no inference pass)."""
    return spark.read.options(header=True, inferSchema=False, **opts).csv(path)


def read_mark_file(spark: SparkSession, path: str) -> DataFrame:
    """Mark/release CSV; ``Length mm`` as double, bad numbers -> NULL."""
    df = read_csv_strings(spark, path)
    if "Length mm" in df.columns:
        df = df.withColumn("Length mm", F.expr("try_cast(`Length mm` AS double)"))
    return df


def read_tag_histories(spark: SparkSession, directory: str) -> DataFrame:
    """All ``*.csv`` tag-history exports in a directory as one table (S3),
    stacked by column name."""
    return read_csv_union(spark, directory)


# --- S4/S5/S6: CSV sets whose headers differ -------------------------------------------

FILE = "_source_file"


def read_csv_union(spark: SparkSession, paths, encoding: str = "utf-8", with_file: bool = False) -> DataFrame:
    """Files grouped by identical header line, each group read in one
    ``spark.read``, groups stacked by column name (missing -> NULL).
    ``with_file`` adds each row's file path as ``_source_file``."""
    files = []
    for p in ([paths] if isinstance(paths, str) else list(paths)):
        files.extend(list_files(spark, p))
    groups: OrderedDict[str, list[str]] = OrderedDict()
    for f, head, _ in file_heads(spark, files, encoding):
        groups.setdefault(head, []).append(f)
    parts = [read_csv_strings(spark, g) for g in groups.values()]
    if with_file:
        parts = [p.withColumn(FILE, F.col("_metadata.file_path")) for p in parts]
    return union_all(*parts)


# --- rejected cells, types of unknown columns ----------------------------------------------

def _cell(column: str):
    return F.col(f"`{column}`")


def cell_checks(columns, numbers=(), times=(), dates=(), date_orders=("ymd", "mdy", "dmy")) -> dict:
    """column -> (expected, parsed value) of the typed columns that are there."""
    out = {}
    for c in columns:
        if c in numbers:
            out[c] = ("a number", F.expr(f"try_cast(`{c}` AS double)"))
        elif c in times:
            out[c] = ("month/day/year and a time", mdy_hms(_cell(c)))
        elif c in dates:
            out[c] = (f"a date ({', '.join(date_orders)})", parse_mixed_date(_cell(c), date_orders))
    return out


def _rejected(column: str, parsed):
    given = _cell(column).isNotNull() & (F.trim(_cell(column)) != "") & (_cell(column) != "NA")
    return given & parsed.isNull()


def problem_report(raw: DataFrame, checks: dict) -> DataFrame:
    """file, column, expected, n: how many cells of the text table ``raw`` (with
    ``_source_file``) their column's type rejects, one row per file and column
    that has some. One aggregation over the files, combined map-side."""
    if not checks:
        return raw.sparkSession.createDataFrame([], PROBLEMS)
    names = list(checks)
    counted = raw.groupBy(FILE).agg(*[F.count_if(_rejected(c, checks[c][1])).alias(f"_n{i}") for i, c in enumerate(names)])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(checks[c][0]).alias("expected"), F.col(f"_n{i}").alias("n"))
                      for i, c in enumerate(names)])
    return counted.select(F.col(FILE).alias("file"), F.explode(cells).alias("_c")).select("file", "_c.*").where("n > 0")


PROBLEMS = "file string, column string, expected string, n long"


def rejected_cells(raw: DataFrame, checks: dict) -> DataFrame:
    """file, column, value of every rejected cell."""
    cells = F.array(*[F.when(_rejected(c, parsed), F.struct(F.lit(c).alias("column"), _cell(c).alias("value")))
                      for c, (_, parsed) in checks.items()])
    return raw.select(F.col(FILE).alias("file"), F.explode(cells).alias("_c")).where("_c IS NOT NULL").select("file", "_c.*")


# Types an unknown column may have, narrowest first.
GUESSES = ("bigint", "double", "date", "timestamp", "boolean")


def _as_type(value, kind: str):
    """A text cell as one of ``GUESSES``, NULL where it is none (a plain cast would
    cut a time to its day and take y or n for a boolean)."""
    if kind == "date":
        return F.try_to_date(value, "yyyy-M-d")
    if kind == "boolean":
        value = F.when(F.lower(value).isin("true", "false", "t", "f"), value)
    return value.try_cast(kind)


def guess_types(raw: DataFrame, known=()) -> DataFrame:
    """``raw`` with every column that is not in ``known`` cast to the narrowest
    type that takes all of its cells (text where none does, or where there is no
    cell). One aggregation finds the types; one row comes back."""
    unknown = [c for c in raw.columns if c not in known and c != FILE]
    if not unknown:
        return raw
    value = {c: F.nullif(F.nullif(F.trim(_cell(c)), F.lit("")), F.lit("NA")) for c in unknown}
    taken = [F.count(_as_type(value[c], t)).alias(f"_{i}_{k}") for i, c in enumerate(unknown) for k, t in enumerate(GUESSES)]
    n = raw.agg(*taken, *[F.count(value[c]).alias(f"_{i}") for i, c in enumerate(unknown)]).first()
    kind = {c: next((t for k, t in enumerate(GUESSES) if n[f"_{i}"] and n[f"_{i}_{k}"] == n[f"_{i}"]), None)
            for i, c in enumerate(unknown)}
    return raw.select(*[_as_type(value[c], kind[c]).alias(c) if kind.get(c) else _cell(c) for c in raw.columns])


# --- S4/S5: window reports, S6: gauges ------------------------------------------------------

WINDOW_TEXT_COLUMNS = {"Project", "Date", "Chinook Run"}
GAUGE_NUMBERS = ("X_00010_00003", "X_00060_00003")


def _with_dates(df: DataFrame, orders) -> DataFrame:
    if "Date" in df.columns:
        df = parse_mixed_date_by(df, "Date", [FILE], orders)
    return df.drop(FILE)


def window_problems(spark: SparkSession, paths, date_orders=("ymd", "mdy", "dmy")) -> DataFrame:
    """``problem_report`` of window-count reports."""
    raw = read_csv_union(spark, paths, with_file=True)
    return problem_report(raw, cell_checks(raw.columns, [c for c in raw.columns if c not in WINDOW_TEXT_COLUMNS | {FILE}],
                                           dates=["Date"], date_orders=date_orders))


def gauge_problems(spark: SparkSession, paths) -> DataFrame:
    """``problem_report`` of landed gauge values."""
    raw = read_csv_union(spark, paths, with_file=True)
    return problem_report(raw, cell_checks(raw.columns, GAUGE_NUMBERS, dates=["Date"]))


def tag_history_problems(spark: SparkSession, directory: str) -> DataFrame:
    """``problem_report`` of tag-history exports: event times."""
    raw = read_csv_union(spark, directory, with_file=True)
    return problem_report(raw, cell_checks(raw.columns, times=["Event Date Time Value"]))


def mark_problems(spark: SparkSession, path: str) -> DataFrame:
    """``problem_report`` of a mark file: length and the two m/d/y dates."""
    raw = read_csv_strings(spark, path).withColumn(FILE, F.col("_metadata.file_path"))
    return problem_report(raw, cell_checks(raw.columns, ["Length mm"], dates=["Mark Date MMDDYYYY", "Release Date MMDDYYYY"],
                                           date_orders=("mdy",)))


def read_window_reports(spark: SparkSession, paths, date_orders=("ymd", "mdy", "dmy")) -> DataFrame:
    """Window-count reports (current or finished layout, any mix),
    ``Date`` unified with the order that fits each file (D3), counts and
    temperature numeric."""
    df = _with_dates(read_csv_union(spark, paths, with_file=True), date_orders)
    for c in df.columns:
        if c not in WINDOW_TEXT_COLUMNS:
            df = df.withColumn(c, F.expr(f"try_cast(`{c}` AS double)"))
    return df


def read_gauge_daily(spark: SparkSession, paths) -> DataFrame:
    """Landed daily gauge values (site_no, Date, X_00010_00003,
    X_00060_00003; either value column may be absent for a site)."""
    df = _with_dates(read_csv_union(spark, paths, with_file=True), ("ymd", "mdy", "dmy"))
    for c in GAUGE_NUMBERS:
        value = F.expr(f"try_cast(`{c}` AS double)") if c in df.columns else F.lit(None).cast("double")
        df = df.withColumn(c, value)
    return df


# --- S7: snapshots -----------------------------------------------------------------------

def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table written by ``sinks.write_snapshot``."""
    from fishladder.sources.sinks import current_version, read_version
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no table at {path}")
    return read_version(spark, path, version.rsplit("/", 1)[1])
