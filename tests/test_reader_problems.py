"""Headers through Spark's own source, rejected cells, guessed types, dates
without moving rows."""

import datetime as dt
import os

from tests.conftest import rows
from pyspark.sql import functions as F

from fishladder.functions.dates import parse_mixed_date_by
from fishladder.plans.queries import REGISTRY
from fishladder.sources import readers

SF = "/root/testdata/sf0.001"


def put(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode(encoding))
    return path


def test_files_that_only_spark_can_open(spark, tmpdir_path):
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.landed.link./in", f"file:{tmpdir_path}/in")
    put(f"{tmpdir_path}/in/a.csv", "Project,Date,Chin\nA,2024-04-03,5\nA,2024-04-04,6\n")
    put(f"{tmpdir_path}/in/b.csv", "Project,Date,TempC\r\nB,2024-04-05,11.5\r\n")
    df = readers.read_window_reports(spark, "viewfs://landed/in")
    assert rows(df, "Project", "Date", "Chin", "TempC") == [
        ("A", dt.date(2024, 4, 3), 5.0, None), ("A", dt.date(2024, 4, 4), 6.0, None), ("B", dt.date(2024, 4, 5), None, 11.5)]
    put(f"{tmpdir_path}/in/rep.csv", "\ufeffTag,Site,Obs Time\r\nT1,LGR X,4/3/2024 5:06:07 AM\r\n", "utf-16-le")
    rep = readers.read_detection_report(spark, "viewfs://landed/in/rep.csv")
    assert rep.columns == ["Tag", "Site", "Obs Time"] and [r["Tag"] for r in rep.collect()] == ["T1"]


def test_heads_of_odd_files(spark, tmpdir_path):
    names = ["plain.csv", "a b%20c.csv", "empty.csv", "no_end.csv", "long.csv", "crlf.csv"]
    wide = ",".join(f"column {i}" for i in range(20000))
    texts = ["x,y\n1,2\n", "\ufeffx\n1\n", "", "only,header", wide + "\n" + "1,\n" * 50000, "p,q\r\n1,2\r\n"]
    files = [readers.list_files(spark, put(f"{tmpdir_path}/h/{n}", t))[0] for n, t in zip(names, texts)]
    before = {k: spark.conf.get(k, None) for k in readers.FILE_PER_TASK}
    got = readers.file_heads(spark, files)
    assert [h for _, h, _ in got] == ["x,y", "x", "", "only,header", wide, "p,q"]
    assert [s for *_, s in got] == ["\n"] * 5 + ["\r\n"] and [f for f, *_ in got] == files
    assert {k: spark.conf.get(k, None) for k in before} == before
    utf16 = put(f"{tmpdir_path}/h/wide.txt", "\ufeffT\u00e4g,\u010a\u0a0a,Z\r\n1,2,3\r\n", "utf-16-le")
    assert readers.file_heads(spark, readers.list_files(spark, utf16, ".txt"), "utf-16-le")[0][1:] == ("T\u00e4g,\u010a\u0a0a,Z", "\r\n")
    assert readers.file_heads(spark, []) == []


def test_rejected_cells_are_counted_per_file_and_column(spark, tmpdir_path):
    a = put(f"{tmpdir_path}/w/a.csv", "Project,Date,Chin,TempC\nA,2024-04-03,five,10\nA,32/32/2024,6,x\nA,2024-04-05,,NA\nA,,sechs,1\n")
    b = put(f"{tmpdir_path}/w/b.csv", "Project,Date,Stlhd\nB,2024-04-03,1\nB,soon,2\n")
    got = {(r["file"].rsplit("/", 1)[1], r["column"]): r["n"] for r in readers.window_problems(spark, [a, b]).collect()}
    assert got == {("a.csv", "Chin"): 2, ("a.csv", "Date"): 1, ("a.csv", "TempC"): 1, ("b.csv", "Date"): 1}
    raw = readers.read_csv_union(spark, [a, b], with_file=True)
    cells = readers.rejected_cells(raw, readers.cell_checks(raw.columns, ["Chin", "TempC"], dates=["Date"]))
    assert sorted((r["column"], r["value"]) for r in cells.collect()) == [
        ("Chin", "five"), ("Chin", "sechs"), ("Date", "32/32/2024"), ("Date", "soon"), ("TempC", "x")]
    g = put(f"{tmpdir_path}/g/peck.csv", "site_no,Date,X_00060_00003\n1,2024-01-02,Ice\n1,2024-01-03,5\n")
    assert [(r["column"], r["n"]) for r in readers.gauge_problems(spark, g).collect()] == [("X_00060_00003", 1)]
    h = put(f"{tmpdir_path}/t/h.csv", "Tag Code,Event Date Time Value\nT,1/2/2024 3:04:05 PM\nT,never\n")
    assert [(r["column"], r["n"]) for r in readers.tag_history_problems(spark, os.path.dirname(h)).collect()] == [("Event Date Time Value", 1)]
    m = put(f"{tmpdir_path}/m.csv", "Tag Code,Length mm,Mark Date MMDDYYYY,Release Date MMDDYYYY\nT,12cm,1/2/2024,\nT,12,13/13/2024,2/3/2024\n")
    assert {(r["column"], r["n"]) for r in readers.mark_problems(spark, m).collect()} == {("Length mm", 1), ("Mark Date MMDDYYYY", 1)}
    assert readers.problem_report(raw, {}).count() == 0


def test_types_of_unknown_columns(spark, tmpdir_path):
    p = put(f"{tmpdir_path}/u.csv", "k,i,d,day,ts,b,t,none\n1,7,1.5,2024-01-02,2024-01-02 03:04:05,true,x,\n2,NA,2,2024-02-03,2024-01-02 00:00:00,false,7,\n")
    df = readers.guess_types(readers.read_csv_strings(spark, p), known=["k"])
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert kinds == {"k": "string", "i": "bigint", "d": "double", "day": "date", "ts": "timestamp", "b": "boolean", "t": "string", "none": "string"}
    assert [r["i"] for r in df.orderBy("k").collect()] == [7, None]


def test_mixed_dates_move_no_rows(spark):
    df = REGISTRY["mixed_dates"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    # the only shuffle is that of the daily report itself
    assert plan.count("Exchange hashpartitioning") == 1


def test_many_files_are_joined(spark):
    data = [(f"f{i % 7}", "25/4/2024" if i % 7 == 3 and i < 20 else "3/4/2024") for i in range(60)] + [(None, "3/4/2024")]
    df = spark.createDataFrame(data, "f string, d string")
    few, many = (sorted(map(repr, parse_mixed_date_by(df, "d", ["f"], order_rows=n).collect())) for n in (10, 0))
    assert few == many
    assert parse_mixed_date_by(df, "d", ["f"]).where(F.col("f") == "f3").select("d").distinct().count() == 2
