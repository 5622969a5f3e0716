"""End to end: landed files -> refresh job -> hand-off tables -> a dashboard panel."""

import datetime as dt
import os

from pyspark.sql import functions as F

from fishladder.plans import dashboard as B
from fishladder.plans.refresh import build_catalog, inputs_from_files

MARK_HEAD = ("Tag Code,Mark Site Name,Release Site Name,Release Date MMDDYYYY,Mark Date MMDDYYYY,"
             "Mark Life Stage Value,Species Name,Length mm,Mark File Name")


def _w(path, text, utf16=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.replace("\n", "\r\n").encode("utf-16-le") if utf16 else text.encode())


def _files(root):
    _w(f"{root}/marks_hist.csv", MARK_HEAD + "\n" + "\n".join([
        "H1,DWOR Dworshak NFH,DWORNF NF Clearwater,3/20/2023,10/1/2022,Juvenile,Chinook,100,f1",
        "H2,DWOR Dworshak NFH,DWORNF NF Clearwater,4/12/2023,10/1/2022,Juvenile,Chinook,101,f1",
        "H3,KOOS Kooskia,KOOS Kooskia,4/1/2022,10/1/2021,Juvenile,Steelhead,150,f2",
        "H4,CLWH Clearwater,SNAKE2 Snake,4/1/2022,10/1/2021,Adult,Steelhead,600,f3",
        "H5,DWOR Dworshak NFH,DWORMS Clearwater,4/1/2023,10/1/2022,Juvenile,Chinook,99,f1"]) + "\n")
    _w(f"{root}/marks_cur.csv", MARK_HEAD + "\n" + "\n".join([
        "C1,DWOR Dworshak NFH,DWORNF NF Clearwater,3/27/2025,10/1/2024,Juvenile,Chinook,100,f9",
        "C2,DWOR Dworshak NFH,DWORMS Clearwater,4/1/2025,10/1/2024,Juvenile,Steelhead,180,f9"]) + "\n")
    th = "Tag Code,Event Type Name,Event Date Time Value,Event Site Code Value\n"
    _w(f"{root}/hist/a.csv", th + "\n".join([
        "H1,Mark,10/1/2022 8:00:00 AM,DWOR", "H1,Observation,4/20/2023 6:00:00 AM,GRJ",
        "H1,Observation,4/20/2023 6:05:00 AM,GRJ", "H1,Observation,5/2/2023 1:00:00 PM,B2J",
        "H2,Observation,5/1/2023 9:00:00 AM,GRJ"]) + "\n")
    _w(f"{root}/hist/b.csv", th + "\n".join([
        "H3,Observation,5/1/2022 9:00:00 AM,GRS", "H3,Observation,8/15/2024 9:00:00 AM,BO1",
        "H3,Observation,8/15/2024 10:00:00 AM,BO2", "H3,Observation,9/30/2024 7:00:00 AM,GRA",
        "H4,Observation,9/30/2024 7:00:00 AM,GRA"]) + "\n")
    _w(f"{root}/hist/ignore.txt", "not a csv\n")
    rep = "Tag,Site,Obs Time\n"
    _w(f"{root}/rep_lower.csv", rep + "C1,GRJ - Lower Granite,04/05/2025 10:00:00\nC1,GRJ - Lower Granite,04/04/2025 09:00:00\n", True)
    _w(f"{root}/rep_columbia.csv", rep + "C1,B2J - Bonneville,04/20/2025 12:00:00\nC2,B2J - Bonneville,04/25/2025 12:00:00\n"
       "C1,MCN - McNary adult ladder,04/15/2025 12:00:00\n", True)
    _w(f"{root}/upstream.csv", "Tag,Site\nC2,CLC - Clear Creek\n", True)
    _w(f"{root}/adult.csv", "Tag,Site,Obs Time,Species Name\n"
       "H3,GRA - Lower Granite Adult,07/05/2025 10:00:00,Steelhead\n"
       "H1,GRA - Lower Granite Adult,06/01/2025 10:00:00,Chinook\n"
       "H5,BO1 - Bonneville,05/01/2025 10:00:00,Coho\n", True)
    cur_head = "Project,Date,Chinook Run,TempC,Chin,JChin,Stlhd,WStlhd,Sock,Coho,JCoho,Shad,LmpryDay,LmpryNight,BTrout,Chum,Pink\n"
    _w(f"{root}/win_cur.csv", cur_head + "Lower Granite,2025-06-20,Su,15,10,2,3,1,,,,,,,,,\n"
       "Lower Granite,2025-07-10,Su,16,12,,4,2,,,,,,,,,\nReport footer,,,,,,,,,,,,,,,,\n")
    fin_head = "Project,Date,Chinook Run,TempC,Chin,JChin,Stlhd,WStlhd,Sock,Coho,JCoho,Shad,Lmpry,BTrout,Chum,Pink\n"
    _w(f"{root}/win_fin.csv", fin_head + "Lower Granite,6/20/2024,Su,15,8,1,2,1,,,,,,,,\n"
       "Lower Granite,20/7/2024,Su,15,9,,3,,,,,,,,,\n")
    _w(f"{root}/gauge_peck.csv", "site_no,Date,X_00010_00003,X_00060_00003\n13341050,2025-07-13,14.5,5000\n"
       "13341050,2025-07-14,,5100\n13341050,2024-01-01,3.0,900\n")
    _w(f"{root}/gauge_lolo.csv", "site_no,Date,X_00060_00003\n13339500,2025-07-14,300\n")


def test_refresh_from_files(spark, tmpdir_path):
    src = f"{tmpdir_path}/in"
    _files(src)
    paths = {"marks_history": f"{src}/marks_hist.csv", "marks_current": f"{src}/marks_cur.csv",
             "tag_history_dir": f"{src}/hist", "reports": [f"{src}/rep_lower.csv", f"{src}/rep_columbia.csv"],
             "upstream": f"{src}/upstream.csv", "adult_report": f"{src}/adult.csv",
             "window_current": [f"{src}/win_cur.csv"], "window_finished": [f"{src}/win_fin.csv"],
             "gauges": [f"{src}/gauge_peck.csv", f"{src}/gauge_lolo.csv"]}
    inp = inputs_from_files(spark, paths, as_of=dt.date(2025, 7, 15), drop_spawn_year=2026)
    out = build_catalog(spark, inp, f"{tmpdir_path}/catalog", chunk_dir=f"{tmpdir_path}/chunks")
    t = {k: spark.read.parquet(v) for k, v in out.items()}

    marks = {r["pit_id"]: r for r in t["marks"].collect()}
    nf = "North Fork Clearwater River"
    assert marks["H1"]["release_group"] == nf + " Early" and marks["H2"]["release_group"] == nf + " Late"
    assert marks["H4"]["release_group"] == "Snake Kelts" and marks["H5"]["release_group"] == "Clearwater River Early"

    juv = {r["pit_id"]: r for r in t["juv_history"].collect()}
    assert len(juv) == 5
    assert juv["H1"]["LGR"] == dt.datetime(2023, 4, 20, 6) and juv["H1"]["lgr_traveltime"] == 31
    assert juv["H1"]["BONN"] == dt.datetime(2023, 5, 2, 13) and juv["H1"]["BONN_ch"] == "1"
    assert juv["H4"]["LGR_ch"] == "0"  # adult mark: no juvenile history

    travel = {r["pit_id"]: r for r in t["travel"].collect()}
    assert set(travel) == {"C1"}  # C2 released on station and seen upstream
    assert travel["C1"]["LGR"] == dt.datetime(2025, 4, 4, 9) and travel["C1"]["lgr_traveltime"] == 8
    assert travel["C1"]["release_group"] == nf + " Early"
    assert travel["C1"]["MCN"] is None  # MCN is not in the in-season site list

    summ = t["emigration_all"]
    assert summ.where(F.col("release_year") == 2025).count() == 1 and summ.where(F.col("release_year") == 2023).count() >= 1

    adults = t["adult_complete"].collect()
    # H3 (Steelhead) passes Bonneville at BO1 and BO2 on 15 Aug 2024 (counted per site) and Lower
    # Granite on 30 Sep: after day 183, so spawn year 2025. H4 is a kelt and is not counted.
    assert {(r["dam"], r["species"], r["spawn_year"], r["daily_total"]) for r in adults} == {
        ("Bonneville", "Steelhead", 2025, 2), ("Lower Granite", "Steelhead", 2025, 1)}
    ins = t["adult_inseason"].collect()   # as of 2025-07-15: Chinook 2025, Steelhead 2026
    assert {(r["dam"], r["species"], r["spawn_year"]) for r in ins} == {
        ("Lower Granite", "Chinook", 2025), ("Lower Granite", "Steelhead", 2026)}

    win = t["window_daily"]
    assert win.where(F.col("species") == "Summer Chinook").where(F.col("life_stage") == "Adult").count() == 4
    steel_cur = win.where((F.col("species") == "Steelhead") & (F.col("origin") == "All") & (F.col("spawn_year") == 2026))
    assert [r["count"] for r in steel_cur.collect()] == [4.0]

    water = {(r["name"], r["date"]) for r in t["water"].collect()}
    assert ("Clearwater (Peck)", dt.date(2024, 1, 1)) not in water and len(water) == 3
    panel = B.gauge_panel(t["water"], "Clearwater (Peck)").collect()[0]
    assert panel["date"] == dt.date(2025, 7, 14) and panel["mean_temp"] is None and panel["mean_discharge"] == 5100.0

    assert sorted(os.listdir(f"{tmpdir_path}/chunks")) == ["._SUCCESS.crc", "_SUCCESS", "chunk=1"]
