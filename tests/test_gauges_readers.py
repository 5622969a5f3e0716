import datetime as dt
import os

from pyspark.sql import functions as F

from fishladder.operators.gauges import gauge_year, latest_reading
from fishladder.sources import lookups as L
from fishladder.sources import readers
from fishladder.sources.sinks import write_snapshot
from tests.conftest import rows

D = dt.date


def test_gauge_year_and_latest(spark):
    raw = spark.createDataFrame([("13341050", D(2025, 2, 28), 4.0, 1000.0), ("13341050", D(2025, 3, 1), None, 1200.0),
                                 ("13341050", D(2024, 2, 27), 1.0, 10.0), ("99", D(2025, 3, 1), 2.0, 5.0)],
                                "site_no string, Date date, X_00010_00003 double, X_00060_00003 double")
    g = gauge_year(raw, L.gauge_sites_df(spark), D(2025, 2, 28))
    assert g.count() == 3 and g.where(F.col("name").isNull()).count() == 1
    last = {r["name"]: r for r in latest_reading(g).collect()}
    assert last["Clearwater (Peck)"]["date"] == D(2025, 3, 1) and last["Clearwater (Peck)"]["mean_temp"] is None


def _utf16(path, lines, bom, crlf):
    nl = "\r\n" if crlf else "\n"
    data = (nl.join(lines) + nl).encode("utf-16-le")
    with open(path, "wb") as f:
        f.write((b"\xff\xfe" if bom else b"") + data)


def test_utf16_reports_all_variants(spark, tmpdir_path):
    lines = ["Tag,Site,Obs Time", "3D9.1,GRJ - Lower Granite,04/05/2025 10:00:00", "3D9.2,GRS - Spill,04/06/2025 11:30:00"]
    results = []
    for bom in (False, True):
        for crlf in (False, True):
            p = os.path.join(tmpdir_path, f"r_{bom}_{crlf}.csv")
            _utf16(p, lines, bom, crlf)
            df = readers.read_detection_report(spark, p)
            results.append((tuple(df.columns), rows(df)))
    assert all(r == results[0] for r in results)
    assert results[0][0] == ("Tag", "Site", "Obs Time")
    assert all("\r" not in v for row in results[0][1] for v in row)


def test_utf16_directory_with_mixed_line_endings(spark, tmpdir_path):
    lines = ["Tag,Site,Obs Time", "3D9.1,GRJ,04/05/2025 10:00:00"]
    _utf16(os.path.join(tmpdir_path, "a.csv"), lines, True, True)
    _utf16(os.path.join(tmpdir_path, "b.csv"), lines[:1] + ["3D9.2,GRS,04/06/2025 10:00:00"], False, False)
    df = readers.read_detection_report(spark, tmpdir_path)
    assert rows(df, "Tag", "Site") == [("3D9.1", "GRJ"), ("3D9.2", "GRS")]


def test_window_reports_mixed_headers_and_dates(spark, tmpdir_path):
    cur = "Project,Date,Chinook Run,TempC,Chin,JChin,LmpryDay,LmpryNight\nLower Granite,2025-04-13,Sp,8.5,10,1,,2\n"
    fin = "Project,Date,Chinook Run,TempC,Chin,JChin,Lmpry\nBonneville,4/13/2024,Sp,7,3,,4\nBonneville,13/4/2023,Sp,7,1,,\n,,,,,,\n"
    open(os.path.join(tmpdir_path, "cur.csv"), "w").write(cur)
    open(os.path.join(tmpdir_path, "fin.csv"), "w").write(fin)
    df = readers.read_window_reports(spark, tmpdir_path)
    assert {"LmpryDay", "LmpryNight", "Lmpry"} <= set(df.columns)
    got = rows(df.where(F.col("Date").isNotNull()), "Project", "Date", "Chin", "Lmpry", "LmpryNight")
    assert got == [("Bonneville", D(2023, 4, 13), 1.0, None, None), ("Bonneville", D(2024, 4, 13), 3.0, 4.0, None),
                   ("Lower Granite", D(2025, 4, 13), 10.0, None, 2.0)]


def test_csvs_stack_by_column_name(spark, tmpdir_path):
    """The same two columns in another order must not change places."""
    open(os.path.join(tmpdir_path, "a.csv"), "w").write("Tag Code,Event Type Name\nT1,Recapture\n")
    open(os.path.join(tmpdir_path, "b.csv"), "w").write("Event Type Name,Tag Code\nObservation,T2\n")
    df = readers.read_tag_histories(spark, tmpdir_path)
    assert rows(df, "Tag Code", "Event Type Name") == [("T1", "Recapture"), ("T2", "Observation")]


def test_headers_of_any_length(spark, tmpdir_path):
    """Two headers that differ only far behind the start of the file."""
    cols = [f"column_with_a_long_name_{i:04d}" for i in range(1200)]
    for name, tail in (("a", ["X", "Y"]), ("b", ["Y", "X"])):
        lines = [",".join(cols + tail), ",".join(["0"] * len(cols) + [c.lower() + name for c in tail])]
        open(os.path.join(tmpdir_path, f"{name}.csv"), "w").write("\n".join(lines) + "\n")
        _utf16(os.path.join(tmpdir_path, f"{name}16.txt"), lines, True, name == "a")
    assert os.path.getsize(os.path.join(tmpdir_path, "a.csv")) > 3 * 8192
    assert rows(readers.read_csv_union(spark, tmpdir_path), "X", "Y") == [("xa", "ya"), ("xb", "yb")]
    for name in "ab":
        df = readers.read_utf16_report(spark, os.path.join(tmpdir_path, f"{name}16.txt"))
        assert rows(df, "X", "Y") == [(f"x{name}", f"y{name}")]


def test_date_order_is_chosen_per_file(spark, tmpdir_path):
    head = "Project,Date,Chinook Run,TempC,Chin\n"
    open(os.path.join(tmpdir_path, "dm.csv"), "w").write(head + "A,3/4/2024,Sp,7,1\nA,25/4/2024,Sp,7,2\nA,2024-04-26,Sp,7,3\n")
    open(os.path.join(tmpdir_path, "md.csv"), "w").write(head + "B,3/4/2024,Sp,7,1\nB,4/25/2024,Sp,7,2\n")
    df = readers.read_window_reports(spark, tmpdir_path)
    assert rows(df, "Project", "Date") == [("A", D(2024, 4, 3)), ("A", D(2024, 4, 25)), ("A", D(2024, 4, 26)),
                                           ("B", D(2024, 3, 4)), ("B", D(2024, 4, 25))]


def test_snapshot_versions(spark, tmpdir_path, monkeypatch):
    from fishladder.sources import sinks
    path = os.path.join(tmpdir_path, "tbl")
    ids = lambda: sorted(r[0] for r in readers.read_snapshot(spark, path).collect())
    first = write_snapshot(spark.range(5), path)
    assert ids() == [0, 1, 2, 3, 4] and first.startswith(path)
    # overwrite a table with a plan that reads it
    write_snapshot(readers.read_snapshot(spark, path).where("id > 1"), path)
    assert ids() == [2, 3, 4]
    assert sorted(r[0] for r in spark.read.parquet(first).collect()) == [0, 1, 2, 3, 4]    # running readers keep theirs

    # the switch fails: an error, and the old version stays current
    real = sinks._pointers
    monkeypatch.setattr(sinks, "_pointers", lambda s, p: [(n - 1, v) for n, v in real(s, p)])
    os.makedirs(os.path.join(path, "_pointers"), exist_ok=True)

    class Refused:
        def __init__(self, fs):
            self.fs = fs

        def createNewFile(self, _):
            return False

        def __getattr__(self, name):
            return getattr(self.fs, name)

    fs_of = sinks._fs
    monkeypatch.setattr(sinks, "_fs", lambda s, p: (lambda jvm, fs, x: (jvm, Refused(fs), x))(*fs_of(s, p)))
    try:
        write_snapshot(spark.range(1), path)
        raise AssertionError("a refused switch must raise")
    except RuntimeError:
        pass
    monkeypatch.undo()
    assert ids() == [2, 3, 4]
    # only the current version and the one before stay
    write_snapshot(spark.range(2), path)
    assert ids() == [0, 1] and len(os.listdir(os.path.join(path, "_pointers"))) <= 4


def test_partitioned_snapshot_has_few_files(spark, tmpdir_path):
    df = spark.range(20000).select((F.col("id") % 5).alias("year"), "id").repartition(16)
    out = write_snapshot(df, os.path.join(tmpdir_path, "t"), "year")
    files = [f for d, _, fs in os.walk(out) for f in fs if f.endswith(".parquet")]
    assert len(files) <= 10 and spark.read.parquet(out).count() == 20000


def test_size_for_input(spark):
    from fishladder.session import input_bytes, size_for_input
    n = input_bytes(spark, "/root/testdata/sf0.01")
    assert n > 1_000_000
    conf = size_for_input(spark, 10 * 2**40)             # 10 TiB compressed input
    assert 10_000 < int(conf["spark.sql.shuffle.partitions"]) <= 50_000
    # the count follows the input; only a job's own limit stops it
    assert int(size_for_input(spark, 100 * 2**40)["spark.sql.shuffle.partitions"]) > 400_000
    assert int(size_for_input(spark, 100 * 2**40, max_partitions=50_000)["spark.sql.shuffle.partitions"]) == 50_000
    assert conf["spark.sql.files.maxPartitionBytes"] == str(128 << 20)
    size_for_input(spark, n)
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) >= spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
