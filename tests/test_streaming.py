import datetime as dt
import os
import time

from fishladder.streaming.inseason import compact, first_detections, ingest_reports, stream_parquet_reports
from tests.conftest import rows

T = dt.datetime


def _utf16(path, lines):
    with open(path, "wb") as f:
        f.write(("\r\n".join(lines) + "\r\n").encode("utf-16-le"))


def test_incremental_first_detection(spark, tmpdir_path):
    landing, out, ckpt = (os.path.join(tmpdir_path, n) for n in ("landing", "out", "ckpt"))
    os.makedirs(landing)
    head = "Tag,Site,Obs Time"
    _utf16(os.path.join(landing, "day1.csv"), [head, "A,GRJ x,04/05/2025 10:00:00", "B,GRS y,04/05/2025 11:00:00"])
    ingest_reports(spark, landing, out, ckpt)
    assert rows(first_detections(spark, out), "pit_id", "obs_datetime") == [
        ("A", T(2025, 4, 5, 10)), ("B", T(2025, 4, 5, 11))]
    time.sleep(1)
    # a later file with an earlier time for A and a new tag C; the old file is not re-read
    _utf16(os.path.join(landing, "day2.csv"), [head, "A,GRJ x,04/05/2025 09:00:00", "C,GRJ x,04/06/2025 08:00:00"])
    ingest_reports(spark, landing, out, ckpt)
    assert rows(first_detections(spark, out), "pit_id", "obs_datetime") == [
        ("A", T(2025, 4, 5, 9)), ("B", T(2025, 4, 5, 11)), ("C", T(2025, 4, 6, 8))]


def test_calls_with_default_arguments_keep_everything(spark, tmpdir_path):
    """The second call sees another landing folder (the first was archived)."""
    out = os.path.join(tmpdir_path, "out")
    head = "Tag,Site,Obs Time"
    for day, line in (("day1", "T1,GRJ x,04/05/2025 10:00:00"), ("day2", "T2,GRS y,04/06/2025 11:00:00")):
        landing = os.path.join(tmpdir_path, day)
        os.makedirs(landing)
        _utf16(os.path.join(landing, "r.csv"), [head, line])
        ingest_reports(spark, landing, out)
    want = [("T1", T(2025, 4, 5, 10)), ("T2", T(2025, 4, 6, 11))]
    assert rows(first_detections(spark, out), "pit_id", "obs_datetime") == want
    # a stream started anew (another checkpoint) cannot replace earlier batches either
    landing = os.path.join(tmpdir_path, "day3")
    os.makedirs(landing)
    _utf16(os.path.join(landing, "r.csv"), [head, "T3,GRS y,04/07/2025 11:00:00"])
    ingest_reports(spark, landing, out, checkpoint=os.path.join(tmpdir_path, "other"))
    want.append(("T3", T(2025, 4, 7, 11)))
    assert rows(first_detections(spark, out), "pit_id", "obs_datetime") == want
    compact(spark, out)
    assert rows(first_detections(spark, out), "pit_id", "obs_datetime") == want
    assert len([d for d in os.listdir(out) if d.startswith("stream=") and os.listdir(os.path.join(out, d))]) == 1


def test_stream_equals_the_registered_query(spark, tmpdir_path):
    from fishladder.plans.queries import REGISTRY
    from fishladder.sources import driver as D
    sf = "/root/testdata/sf0.001"
    got = stream_parquet_reports(spark, sf, "lineitem.parquet", D.report_rows, os.path.join(tmpdir_path, "out"))
    cols = ["pit_id", "site", "sitecode"]
    want = REGISTRY["first_per_site_stream"](spark, sf)
    key = lambda df: sorted(tuple(str(x) for x in r) for r in df.select(*cols, "obs_datetime").collect())
    assert key(got) == key(want)
