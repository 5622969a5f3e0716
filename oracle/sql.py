"""Oracle SQL per registered query (DuckDB dialect, driver tables as views)."""

from oracle import views as V
from oracle.views import DAMS, NF, with_

SQL: dict = {}

FPS = """
fps AS (SELECT pit_id, site, sitecode, min(obs_datetime) AS obs_datetime
        FROM report WHERE obs_datetime IS NOT NULL GROUP BY pit_id, site, sitecode)"""
INSEASON_WIDE = FPS + f""",
wide AS (SELECT f.pit_id, {V.wide_min('f.obs_datetime')}
         FROM fps f JOIN damkey k ON f.sitecode = k.sitecode GROUP BY f.pit_id),
mw AS (SELECT m.*, CAST(year(m.release_date) AS INTEGER) AS release_year, {", ".join("w." + d for d in DAMS)}
       FROM marks0 m LEFT JOIN wide w ON m.pit_id = w.pit_id)"""

SQL["marks_clean"] = with_(V.MARKS0) + """
SELECT pit_id, hatchery, mark_date, release_site, release_sitecode, release_date,
       mark_lifestage, species, length_mm, tag_file FROM marks0"""

SQL["detections_clean"] = with_(V.DET) + "SELECT * FROM det"

SQL["report_clean"] = with_(V.REPORT) + "SELECT pit_id, obs_datetime, site, sitecode FROM report"

SQL["mixed_dates"] = """
WITH w AS (
  SELECT DISTINCT CASE o_orderstatus WHEN 'F' THEN 'Lower Granite' WHEN 'O' THEN 'Bonneville'
                                     WHEN 'P' THEN 'Little Goose' END AS dam,
         CAST(o_orderdate AS DATE) AS d
  FROM orders),
t AS (
  SELECT dam, CASE dam WHEN 'Lower Granite' THEN strftime(d, '%Y-%m-%d')
                       WHEN 'Bonneville' THEN strftime(d, '%-m/%-d/%Y')
                       ELSE strftime(d, '%-d/%-m/%Y') END AS date_text
  FROM w)
-- per dam (file): the layout that parses most values goes first, ties as listed
, p AS (
  SELECT dam, date_text, try_strptime(date_text, '%Y-%m-%d') AS d1, try_strptime(date_text, '%m/%d/%Y') AS d2,
         try_strptime(date_text, '%d/%m/%Y') AS d3 FROM t),
n AS (SELECT dam, count(d1) AS n1, count(d2) AS n2, count(d3) AS n3 FROM p GROUP BY dam),
o AS (
  SELECT dam, date_text, d, row_number() OVER (PARTITION BY dam, date_text ORDER BY n DESC, i) AS rn FROM (
    SELECT p.dam, date_text, d1 AS d, n1 AS n, 1 AS i FROM p JOIN n ON p.dam = n.dam UNION ALL
    SELECT p.dam, date_text, d2, n2, 2 FROM p JOIN n ON p.dam = n.dam UNION ALL
    SELECT p.dam, date_text, d3, n3, 3 FROM p JOIN n ON p.dam = n.dam) WHERE d IS NOT NULL)
SELECT t.dam, t.date_text, CAST(o.d AS DATE) AS date
FROM t LEFT JOIN o ON t.dam = o.dam AND t.date_text = o.date_text AND o.rn = 1"""

SQL["first_per_site"] = """
SELECT pit_id, site, sitecode, obs_datetime FROM (
  SELECT user_id AS pit_id, event_type AS site, event_type AS sitecode,
         CAST(ts AS TIMESTAMP) AS obs_datetime,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts) AS rn
  FROM events WHERE ts IS NOT NULL) WHERE rn = 1"""

FPD = """
fpd AS (
  SELECT pit_id, obs_date, obs_sitecode, obs_datetime, obs_type, obs_year FROM (
    SELECT *, row_number() OVER (PARTITION BY pit_id, obs_date, obs_sitecode
                                 ORDER BY obs_datetime, obs_type NULLS FIRST, obs_year NULLS FIRST) AS rn
    FROM det WHERE obs_datetime IS NOT NULL) WHERE rn = 1)"""

SQL["first_per_site_day"] = with_(V.DET, FPD) + "SELECT * FROM fpd"

SQL["first_per_site_stream"] = with_(V.REPORT, FPS) + "SELECT * FROM fps"

LONG = FPS + """,
long AS (SELECT f.pit_id, k.dam_code, min(f.obs_datetime) AS first_detection
         FROM fps f LEFT JOIN damkey k ON f.sitecode = k.sitecode GROUP BY f.pit_id, k.dam_code)"""

SQL["first_per_dam"] = with_(V.REPORT, V.DAMKEY, LONG) + "SELECT * FROM long"

SQL["dam_grid"] = with_(V.REPORT, V.DAMKEY, LONG) + f"""
, levels AS (
  SELECT unnest([{", ".join(f"'{d}'" for d in DAMS)}]) AS dam_code
  UNION ALL SELECT NULL WHERE EXISTS (SELECT 1 FROM long WHERE dam_code IS NULL))
SELECT t.pit_id, l.dam_code, g.first_detection
FROM (SELECT DISTINCT pit_id FROM long) t CROSS JOIN levels l
LEFT JOIN long g ON g.pit_id = t.pit_id AND g.dam_code IS NOT DISTINCT FROM l.dam_code"""

SQL["history_wide"] = with_(V.MARKS0, V.REPORT, V.DAMKEY, INSEASON_WIDE) + f"""
SELECT pit_id, species, tag_file, hatchery, release_date, release_year, mark_date,
       release_sitecode, length_mm, {", ".join(DAMS)} FROM mw"""

SQL["capture_flags"] = with_(V.MARKS0, V.REPORT, V.DAMKEY, INSEASON_WIDE) + f"""
SELECT pit_id, {", ".join(f"CASE WHEN {d} IS NULL THEN '0' ELSE '1' END AS {d}_ch" for d in DAMS)} FROM mw"""

SQL["travel_days"] = with_(V.MARKS0, V.REPORT, V.DAMKEY, INSEASON_WIDE) + f"""
SELECT pit_id, epoch(CAST(release_date AS TIMESTAMP)) AS release_time,
       {", ".join(f"epoch({d}) AS {d}_time" for d in DAMS)},
       {", ".join(f"CAST(floor((epoch({d}) - epoch(CAST(release_date AS TIMESTAMP))) / 86400.0) AS BIGINT) AS {d.lower()}_traveltime" for d in DAMS)}
FROM mw"""

DATED_GROUP = f"""CASE
      WHEN release_sitecode = 'DWORMS' THEN 'Clearwater River'
      WHEN release_sitecode = 'CLEARC' THEN 'Clear Creek'
      WHEN release_sitecode = 'CLWRSF' THEN 'South Fork Clearwater River'
      WHEN release_sitecode = 'NEWSOC' THEN 'Newsome Creek'
      WHEN release_sitecode = 'MEAD2C' THEN 'Meadow Creek'
      WHEN release_sitecode = 'KOOS' THEN 'Kooskia'
      WHEN release_sitecode IN ('DWORNF', 'CLWHNF') AND CAST(release_date AS DATE) = DATE '1999-01-01' THEN '{NF} Early'
      WHEN release_sitecode IN ('DWORNF', 'CLWHNF') AND CAST(release_date AS DATE) = DATE '1999-04-01' THEN '{NF} Late'
      WHEN release_sitecode = 'POWP' THEN 'Powell'
      WHEN release_sitecode = 'REDP' THEN 'Red River'
      WHEN release_sitecode = 'SELWY1' THEN 'Selway River'
    END"""

TRAVEL = INSEASON_WIDE + f""",
travel AS (
  SELECT *, {DATED_GROUP} AS release_group, {V.flags_and_times('CAST(release_date AS TIMESTAMP)')}
  FROM mw
  WHERE pit_id NOT IN (SELECT pit_id FROM marks0
                       WHERE release_sitecode IN ('DWORMS', 'DWORNF')
                         AND pit_id IN (SELECT pit_id FROM upstream)))"""

INSEASON_TRAVEL = (V.MARKS0, V.REPORT, V.DAMKEY, V.UPSTREAM, TRAVEL)

SQL["upstream_excluded"] = with_(*INSEASON_TRAVEL) + f"""
SELECT {V.history_select('CAST(release_date AS TIMESTAMP)')} FROM travel"""

SQL["release_order"] = with_(V.MARKS_ORDERED) + """
SELECT pit_id, hatchery, species, release_sitecode, release_date, release_year, release_order FROM marks_ord"""

SQL["release_group"] = with_(V.MARKS) + "SELECT * FROM marks"

SQL["release_group_dated"] = with_(V.MARKS0) + f"""
SELECT pit_id, release_sitecode, release_date, {DATED_GROUP} AS release_group FROM marks0"""

SQL["years_at_large"] = with_(V.MARKS, V.DET, FPD) + """
SELECT f.pit_id, f.obs_date, f.obs_sitecode, m.release_year, f.obs_year,
       f.obs_year - m.release_year AS years_at_large,
       CASE WHEN f.obs_year - m.release_year = 0 THEN 'juvenile'
            WHEN f.obs_year - m.release_year > 0 THEN 'adult' END AS stage
FROM fpd f JOIN marks m ON f.pit_id = m.pit_id
WHERE m.release_year IS NOT NULL"""

JUV = f"""
juvdet AS (
  SELECT d.pit_id, k.dam_code, min(d.obs_datetime) AS first_detection
  FROM marks m JOIN det d ON m.pit_id = d.pit_id JOIN damkey k ON d.obs_sitecode = k.sitecode
  WHERE d.obs_year - m.release_year = 0 AND m.mark_lifestage = 'Juvenile'
  GROUP BY d.pit_id, k.dam_code),
juvwide AS (SELECT pit_id, {V.wide_min('first_detection')} FROM juvdet GROUP BY pit_id),
juv0 AS (SELECT m.*, {", ".join("w." + d for d in DAMS)} FROM marks m LEFT JOIN juvwide w ON m.pit_id = w.pit_id),
juv AS (SELECT *, {V.flags_and_times('CAST(release_date AS TIMESTAMP)')} FROM juv0)"""

JUVENILE = (V.MARKS, V.DET, V.DAMKEY, JUV)

SQL["juvenile_history"] = with_(*JUVENILE) + f"SELECT {V.history_select()} FROM juv"


def summary_sql(src: str) -> str:
    return f"""
SELECT hatchery, species, release_year, release_group,
       CAST(floor(median(lgr_traveltime)) AS BIGINT) AS median_lgr,
       CAST(median(LGR) AS DATE) AS median_lgr_date,
       count(LGR) AS lgr_detections,
       CAST(floor(median(bonn_traveltime)) AS BIGINT) AS median_bonn,
       CAST(median(BONN) AS DATE) AS median_bonn_date,
       count(BONN) AS bonn_detections,
       CASE WHEN count(release_date) = count(*) THEN strftime(min(release_date), '%B %d') END AS earliest_release,
       CASE WHEN count(release_date) = count(*) THEN strftime(max(release_date), '%B %d') END AS latest_release
FROM {src} GROUP BY hatchery, species, release_year, release_group"""


SQL["emigration_summary"] = with_(*JUVENILE) + summary_sql("juv")

SQL["emigration_all"] = with_(*JUVENILE, V.REPORT, V.UPSTREAM, TRAVEL) + \
    summary_sql("juv") + "\nUNION ALL BY NAME\n" + summary_sql("travel")


# --- adult passage ------------------------------------------------------------------------

def calendar_cols(ts: str) -> str:
    doy = f"dayofyear({ts})"
    return f"""CAST({doy} AS INTEGER) AS day_of_year,
         CASE WHEN species = 'Steelhead' AND {doy} < 183 THEN DATE '1977-01-01' + CAST({doy} AS INTEGER)
              ELSE DATE '1976-01-01' + CAST({doy} - 1 AS INTEGER) END AS dummy_date,
         CAST(CASE WHEN species = 'Steelhead' AND {doy} >= 183 THEN year({ts}) + 1
                   ELSE year({ts}) END AS INTEGER) AS spawn_year"""


ADULTS_HIST = f"""
adults0 AS (
  SELECT f.pit_id, f.obs_datetime, f.obs_sitecode, f.obs_type, m.species, m.hatchery, m.release_group,
         m.release_year, f.obs_year, f.obs_year - m.release_year AS years_at_large
  FROM fpd f JOIN marks m ON f.pit_id = m.pit_id
  WHERE f.obs_year - m.release_year > 0 AND f.obs_type IN ('recapture', 'passive recapture', 'observation')),
adults AS (
  SELECT *, CAST(spawn_year - release_year - CASE WHEN species = 'Steelhead' THEN 1 ELSE 0 END AS INTEGER) AS ocean_age
  FROM (SELECT *, {calendar_cols('obs_datetime')} FROM adults0))"""

ADULTS_INSEASON = f"""
radults0 AS (
  SELECT l_orderkey AS pit_id, 'S' || CAST(l_linenumber AS VARCHAR) AS obs_sitecode,
         {V.OBS_TIME} AS obs_datetime
  FROM lineitem WHERE l_returnflag IN ('A', 'N')),
radults1 AS (
  SELECT r.pit_id, r.obs_sitecode, r.obs_datetime, m.species, m.hatchery, m.release_group, m.release_year,
         CAST(year(r.obs_datetime) AS INTEGER) AS obs_year
  FROM radults0 r JOIN marks m ON r.pit_id = m.pit_id
  WHERE year(r.obs_datetime) - m.release_year > 0),
radults AS (SELECT *, {calendar_cols('obs_datetime')} FROM radults1)"""

HIST_ADULT_CTES = (V.MARKS, V.DET, FPD, ADULTS_HIST)
INSEASON_ADULT_CTES = (V.MARKS, ADULTS_INSEASON)

PASSAGE_SITES = {"Lower Granite": ("('S1', 'S2')", False), "Bonneville": ("('S3', 'S4', 'S5')", True),
                 "Dworshak Ladder": ("('S7')", True)}


def last_event_sql(src: str, sites: str, per_site: bool) -> str:
    part = "pit_id, obs_year" + (", obs_sitecode" if per_site else "")
    return f"""
SELECT {part}, obs_datetime, dummy_date, spawn_year, species, hatchery FROM (
  SELECT *, row_number() OVER (PARTITION BY {part}
                               ORDER BY obs_datetime DESC, dummy_date DESC, spawn_year DESC,
                                        species DESC, hatchery DESC) AS rn
  FROM {src} WHERE obs_sitecode IN {sites} AND release_group <> 'Snake Kelts' AND obs_datetime IS NOT NULL)
WHERE rn = 1"""


def daily_sql(events_sql: str) -> str:
    return f"""
SELECT dummy_date, spawn_year, species, hatchery, daily_total,
       CAST(sum(daily_total) OVER (PARTITION BY spawn_year, species, hatchery ORDER BY dummy_date
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_total,
       CAST(sum(daily_total) OVER (PARTITION BY spawn_year, species, hatchery) AS BIGINT) AS annual_total
FROM (SELECT dummy_date, spawn_year, species, hatchery, count(*) AS daily_total
      FROM ({events_sql}) GROUP BY dummy_date, spawn_year, species, hatchery)"""


def dams_sql(src: str, where: str) -> str:
    parts = []
    for dam, (sites, per_site) in PASSAGE_SITES.items():
        parts.append(f"SELECT *, '{dam}' AS dam FROM ({daily_sql(last_event_sql(src, sites, per_site))}) WHERE {where}")
    return "\nUNION ALL\n".join(parts)


INSEASON_SEASON = "((species = 'Chinook' AND spawn_year = 2001) OR (species = 'Steelhead' AND spawn_year = 2002))"

SQL["adult_calendar"] = with_(*HIST_ADULT_CTES) + """
SELECT pit_id, obs_datetime, obs_sitecode, obs_type, species, hatchery, release_group, release_year,
       obs_year, years_at_large, day_of_year, dummy_date, spawn_year, ocean_age FROM adults"""

SQL["last_passage"] = with_(*HIST_ADULT_CTES) + last_event_sql("adults", "('S1', 'S2')", False)
SQL["last_passage_site"] = with_(*HIST_ADULT_CTES) + last_event_sql("adults", "('S3', 'S4', 'S5')", True)
SQL["adult_daily"] = with_(*INSEASON_ADULT_CTES) + daily_sql(last_event_sql("radults", "('S1', 'S2')", False))
SQL["adult_inseason"] = with_(*INSEASON_ADULT_CTES) + dams_sql("radults", INSEASON_SEASON)
SQL["adult_complete"] = with_(*HIST_ADULT_CTES) + dams_sql("adults", "spawn_year <> 2001")
SQL["adult_all_dams"] = with_(*HIST_ADULT_CTES, ADULTS_INSEASON) + \
    dams_sql("adults", "spawn_year <> 2001") + "\nUNION ALL\n" + dams_sql("radults", INSEASON_SEASON)


def dense_sql(src_sql: str, limits_sql: str, join_cols: str) -> str:
    keys = ["species", "hatchery", "spawn_year", "dam"]
    on = " AND ".join(f"g.{k} IS NOT DISTINCT FROM d.{k}" for k in keys)
    co = ", ".join(f"COALESCE(g.{k}, d.{k}) AS {k}" for k in keys)
    part = ", ".join(keys)
    return f"""
WITH pt AS ({src_sql}),
lim AS ({limits_sql}),
d AS (SELECT pt.*, lim.lim_date FROM pt LEFT JOIN lim USING ({join_cols})),
b AS (SELECT {part}, min(dummy_date) AS lo, max(lim_date) AS hi FROM d GROUP BY {part}
      HAVING max(lim_date) >= min(dummy_date)),
grid AS (SELECT {part}, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS dummy_date FROM b),
f AS (SELECT {co}, COALESCE(g.dummy_date, d.dummy_date) AS dummy_date,
             d.daily_total, d.running_total, d.annual_total
      FROM grid g FULL OUTER JOIN d ON {on} AND g.dummy_date = d.dummy_date)
SELECT {part}, dummy_date, COALESCE(daily_total, 0) AS daily_total,
  last_value(running_total IGNORE NULLS) OVER (PARTITION BY {part} ORDER BY dummy_date
     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_total,
  last_value(annual_total IGNORE NULLS) OVER (PARTITION BY {part} ORDER BY dummy_date
     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS annual_total
FROM f"""


MAX_DATES_SQL = """SELECT * FROM (VALUES
  ('Chinook', 'Lower Granite', DATE '1976-07-15'), ('Steelhead', 'Lower Granite', DATE '1977-05-01'),
  ('Chinook', 'Bonneville', DATE '1976-07-15'), ('Steelhead', 'Bonneville', DATE '1977-05-01'),
  ('Chinook', 'Dworshak Ladder', DATE '1976-09-15'), ('Steelhead', 'Dworshak Ladder', DATE '1977-05-01'))
  AS t(species, dam, lim_date)"""

ASOF_MAX_SQL = """SELECT species,
  CASE WHEN species = 'Steelhead' AND month(DATE '2001-07-14') < 7
       THEN DATE '1977-01-01' + CAST(dayofyear(DATE '2001-07-14') AS INTEGER)
       ELSE DATE '1976-01-01' + CAST(dayofyear(DATE '2001-07-14') AS INTEGER) END AS lim_date
  FROM (VALUES ('Steelhead'), ('Chinook')) AS s(species)"""


def _inner(ctes, body):
    return "SELECT * FROM (" + with_(*ctes) + body + ")"


SQL["season_dense"] = dense_sql(_inner(HIST_ADULT_CTES, dams_sql("adults", "spawn_year <> 2001")),
                                MAX_DATES_SQL, "species, dam")
SQL["season_dense_asof"] = dense_sql(_inner(INSEASON_ADULT_CTES, dams_sql("radults", INSEASON_SEASON)),
                                     ASOF_MAX_SQL, "species")
SQL["qa_ocean_age"] = with_(*HIST_ADULT_CTES) + \
    "SELECT species, ocean_age, count(*) AS n FROM adults GROUP BY species, ocean_age"


# --- window counts ------------------------------------------------------------------------

WINDOW_CURRENT_SPECIES = ["Chinook", "Jack_Chinook", "Steelhead", "Wild_Steelhead", "Sockeye", "Coho",
                          "Jack_Coho", "Shad", "Lamprey_Day", "Lamprey_Night", "Bull Trout", "Chum", "Pink"]
WINDOW_FINISHED_SPECIES = ["Chinook", "Jack_Chinook", "Steelhead", "Wild_Steelhead", "Sockeye", "Coho",
                           "Jack_Coho", "Shad", "Lamprey", "Bull Trout", "Chum", "Pink"]

WREP = """
wrep AS (
  SELECT CASE o_orderstatus WHEN 'F' THEN 'Lower Granite' WHEN 'O' THEN 'Bonneville'
                            WHEN 'P' THEN 'Little Goose' END AS dam,
         CAST(o_orderdate AS DATE) AS date,
         sum(CAST(round(o_totalprice * 100) AS BIGINT)) / count(o_totalprice) / 1000000.0 AS temp,
         CAST(NULLIF(count(*) FILTER (WHERE substr(o_orderpriority, 1, 1) = '1'), 0) AS DOUBLE) AS c_chin,
         CAST(NULLIF(count(*) FILTER (WHERE substr(o_orderpriority, 1, 1) = '2'), 0) AS DOUBLE) AS c_jchin,
         CAST(NULLIF(count(*) FILTER (WHERE substr(o_orderpriority, 1, 1) = '3'), 0) AS DOUBLE) AS c_sthd,
         CAST(NULLIF(count(*) FILTER (WHERE substr(o_orderpriority, 1, 1) = '4'), 0) AS DOUBLE) AS c_wsthd,
         CAST(NULLIF(count(*) FILTER (WHERE substr(o_orderpriority, 1, 1) = '5'), 0) AS DOUBLE) AS c_coho
  FROM orders GROUP BY 1, 2)"""


def wlong(name: str, species: list) -> str:
    vals = ", ".join(f"('{s}')" for s in species)
    return f"""
{name}_0 AS (
  SELECT w.dam, w.date, CAST(year(w.date) AS INTEGER) AS year, w.temp, s.sp AS sp0,
         CASE s.sp WHEN 'Chinook' THEN w.c_chin WHEN 'Jack_Chinook' THEN w.c_jchin
                   WHEN 'Steelhead' THEN w.c_sthd WHEN 'Wild_Steelhead' THEN w.c_wsthd
                   WHEN 'Coho' THEN w.c_coho ELSE CAST(NULL AS DOUBLE) END AS count,
         CASE WHEN month(w.date) BETWEEN 3 AND 5 THEN 'Spring' WHEN month(w.date) BETWEEN 6 AND 7 THEN 'Summer'
              WHEN month(w.date) BETWEEN 8 AND 11 THEN 'Fall' END AS run_type
  FROM wrep w CROSS JOIN (VALUES {vals}) AS s(sp)),
{name}_1 AS (
  SELECT dam, date, year, run_type, temp, count,
         CASE WHEN sp0 IN ('Jack_Chinook', 'Jack_Coho') THEN 'Jack' WHEN sp0 IN ('Chinook', 'Coho') THEN 'Adult'
              ELSE 'All' END AS life_stage,
         CASE WHEN sp0 = 'Wild_Steelhead' THEN 'Wild' ELSE 'All' END AS origin,
         CASE WHEN sp0 IN ('Wild_Steelhead', 'Jack_Chinook', 'Jack_Coho') THEN split_part(sp0, '_', 2)
              ELSE sp0 END AS sp1
  FROM {name}_0),
{name} AS (
  SELECT dam, date, year, run_type, temp,
         CASE WHEN sp1 = 'Chinook' THEN run_type || ' ' || sp1 ELSE sp1 END AS species,
         count, life_stage, origin
  FROM {name}_1),
{name}_cal AS (
  SELECT *, make_date(year(date), 7, 1) AS july_first,
         CASE WHEN species = 'Steelhead' AND date < make_date(year(date), 7, 1)
              THEN try_cast('1977-' || strftime(date, '%m-%d') AS DATE)
              ELSE try_cast('1976-' || strftime(date, '%m-%d') AS DATE) END AS dummy_date,
         CAST(CASE WHEN species = 'Steelhead' AND date >= make_date(year(date), 7, 1) THEN year(date) + 1
                   ELSE year(date) END AS INTEGER) AS spawn_year
  FROM {name}),
{name}_run AS (
  SELECT dam, date, year, run_type, temp, species, COALESCE(count, 0) AS count, life_stage, origin,
         july_first, dummy_date, spawn_year,
         sum(COALESCE(count, 0)) OVER (PARTITION BY spawn_year, dam, species, life_stage, origin
             ORDER BY dummy_date NULLS LAST, date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_total,
         sum(COALESCE(count, 0)) OVER (PARTITION BY spawn_year, dam, species, life_stage, origin) AS annual_total
  FROM {name}_cal)"""


CUR_SY = """
cur_sy AS (SELECT sp AS species, CAST(CASE WHEN sp = 'Steelhead' AND dayofyear(DATE '2001-07-15') >= 183
                                           THEN 2002 ELSE 2001 END AS INTEGER) AS cur_year
           FROM (VALUES ('Steelhead'), ('Chinook'), ('Bull Trout'), ('Chum'), ('Coho'), ('Lamprey_Day'),
                        ('Lamprey_Night'), ('Pink'), ('Shad'), ('Sockeye'), ('Spring Chinook'),
                        ('Summer Chinook'), ('Fall Chinook')) AS s(sp))"""

WCOLS = ("dam, date, year, run_type, temp, species, count, life_stage, origin, july_first, dummy_date, "
         "spawn_year, running_total, annual_total")
WINDOW_ALL = WREP + "," + wlong("wc", WINDOW_CURRENT_SPECIES) + "," + wlong("wf", WINDOW_FINISHED_SPECIES) \
    + "," + CUR_SY + f""",
wcur AS (SELECT r.* FROM wc_run r JOIN cur_sy c ON r.species = c.species AND r.spawn_year = c.cur_year),
wfin AS (SELECT * FROM wf_run WHERE year(date) < 2001
            OR (species = 'Steelhead' AND year(date) = 2001 AND date < july_first)),
wall AS (SELECT {WCOLS} FROM wcur UNION ALL SELECT {WCOLS} FROM wfin),
wdash AS (SELECT * FROM wall WHERE NOT (species = 'Steelhead' AND origin = 'Wild') AND life_stage <> 'Jack')"""

SQL["window_long"] = with_(WREP, wlong("wc", WINDOW_CURRENT_SPECIES)) + "SELECT * FROM wc"
SQL["window_calendar"] = with_(WREP, wlong("wc", WINDOW_CURRENT_SPECIES)) + "SELECT * FROM wc_cal"
SQL["window_daily"] = with_(WREP, wlong("wc", WINDOW_CURRENT_SPECIES)) + "SELECT * FROM wc_run"
SQL["window_current"] = with_(WINDOW_ALL) + "SELECT * FROM wcur"
SQL["window_finished"] = with_(WINDOW_ALL) + "SELECT * FROM wfin"
SQL["window_all"] = with_(WINDOW_ALL) + "SELECT * FROM wall"

# --- gauges ---------------------------------------------------------------------------------

GAUGE = """
graw AS (SELECT event_type AS sitenumber, CAST(ts AS DATE) AS date,
                sum(CAST(round(value * 100) AS BIGINT)) / count(value) / 100.0 AS mean_temp,
                sum(CAST(round(value * 100) AS BIGINT)) / 100.0 AS mean_discharge
         FROM events GROUP BY event_type, CAST(ts AS DATE)),
gsites AS (SELECT * FROM (VALUES ('Clearwater (Peck)', 'click'), ('Clearwater (Orofino)', 'error'),
                                 ('Lolo Creek', 'purchase'), ('SF Clearwater', 'signup'), ('Selway', 'view'))
           AS t(name, sitenumber)),
gauge AS (SELECT g.sitenumber, g.date, g.mean_temp, g.mean_discharge, CAST(year(g.date) AS INTEGER) AS year,
                 s.name, g.sitenumber AS "group"
          FROM graw g LEFT JOIN gsites s ON g.sitenumber = s.sitenumber
          WHERE g.date >= DATE '2023-01-30'),
glatest AS (
  SELECT name, date, sitenumber, mean_temp, mean_discharge, round_even(mean_temp * 9.0 / 5.0 + 32.0, 1) AS mean_temp_f
  FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY date DESC, sitenumber DESC,
                                     mean_temp DESC, mean_discharge DESC) AS rn FROM gauge WHERE date IS NOT NULL)
  WHERE rn = 1)"""

SQL["gauge_year"] = with_(GAUGE) + "SELECT * FROM gauge"
SQL["gauge_latest"] = with_(GAUGE) + "SELECT * FROM glatest"

# --- chunks and tallies ------------------------------------------------------------------------

SQL["tag_chunks"] = with_(V.MARKS0) + """
SELECT CAST(floor((row_number() OVER (ORDER BY pit_id) - 1) / 10000) + 1 AS INTEGER) AS chunk, pit_id FROM marks0"""
SQL["qa_release_sites"] = with_(V.MARKS0) + \
    "SELECT release_site, release_date, count(*) AS n FROM marks0 GROUP BY release_site, release_date"
SQL["qa_life_stage"] = with_(V.MARKS0) + "SELECT mark_lifestage, count(*) AS n FROM marks0 GROUP BY mark_lifestage"
SQL["qa_release_tally"] = with_(V.MARKS0) + """
SELECT hatchery, species, release_sitecode, release_date, count(*) AS n,
       CAST(year(release_date) AS INTEGER) AS release_year,
       CAST(row_number() OVER (PARTITION BY hatchery, species, release_sitecode, year(release_date)
                               ORDER BY release_date NULLS LAST) AS INTEGER) AS release_order
FROM marks0 GROUP BY hatchery, species, release_sitecode, release_date"""
SQL["qa_inseason_release"] = with_(*INSEASON_TRAVEL) + """
SELECT species, hatchery, release_sitecode, CAST(release_date AS TIMESTAMP) AS release_date, count(*) AS n
FROM travel GROUP BY species, hatchery, release_sitecode, CAST(release_date AS TIMESTAMP)"""

# --- dashboard ----------------------------------------------------------------------------------

TRAVEL_TS = """
travel_ts AS (SELECT * REPLACE (CAST(release_date AS TIMESTAMP) AS release_date) FROM travel)"""
CHINOOK_SEL = f"""
sel AS (SELECT * FROM travel_ts WHERE species = 'Chinook'
          AND release_group IN ('{NF} Early', '{NF} Late', 'Kooskia'))"""
STEELHEAD_SEL = """
sel AS (SELECT * FROM travel_ts WHERE species = 'Steelhead' AND hatchery = 'BUILDING')"""


def juv_ctes(sel: str):
    return INSEASON_TRAVEL + (TRAVEL_TS, sel)


SQL["b01"] = with_(*juv_ctes(CHINOOK_SEL)) + f"SELECT {V.history_select()} FROM sel"
SQL["b01_steelhead"] = with_(*juv_ctes(STEELHEAD_SEL)) + f"SELECT {V.history_select()} FROM sel"
SQL["b02"] = with_(*juv_ctes(CHINOOK_SEL)) + """
SELECT min(species) AS selected_species, count(*) FILTER (WHERE hatchery = 'BUILDING') AS tag_count,
       'Number Tagged: ' || format('{:,}', count(*) FILTER (WHERE hatchery = 'BUILDING')) AS tag_label
FROM sel"""


def timing_sql(species: str, dam: str) -> str:
    return f"""
, arr AS (SELECT * FROM sel WHERE {dam} IS NOT NULL),
g AS (SELECT hatchery, release_group, min(release_date) AS release_date, median({dam}) AS median_arrival
      FROM arr GROUP BY hatchery, release_group),
lim AS (SELECT (SELECT min(release_date) FROM arr) - INTERVAL 2 DAY AS xmin,
               (SELECT max({dam}) FROM travel_ts WHERE species = '{species}') + INTERVAL 7 DAY AS xmax)
SELECT g.hatchery, g.release_group, g.release_date, g.median_arrival,
       CAST(floor((epoch(g.median_arrival) - epoch(g.release_date)) / 86400.0) AS BIGINT) AS travel_days,
       lim.xmin, lim.xmax
FROM g, lim"""


def density_sql(species: str, dam: str) -> str:
    return f"""
, arr AS (SELECT * FROM sel WHERE {dam} IS NOT NULL),
lim AS (SELECT epoch_us((SELECT min(release_date) FROM arr) - INTERVAL 2 DAY) / 86400000000.0 AS lo,
               epoch_us((SELECT max({dam}) FROM travel_ts WHERE species = '{species}') + INTERVAL 7 DAY)
                 / 86400000000.0 AS hi),
pts AS (SELECT a.hatchery, a.release_group, epoch_us(a.{dam}) / 86400000000.0 AS x
        FROM arr a, lim WHERE epoch_us(a.{dam}) / 86400000000.0 BETWEEN lim.lo AND lim.hi),
st AS (SELECT hatchery, release_group, count(*) AS n, stddev_samp(x) AS sd, quantile_cont(x, 0.25) AS q1,
              quantile_cont(x, 0.75) AS q3, min(x) AS x1
       FROM pts GROUP BY hatchery, release_group HAVING count(*) >= 2),
bw AS (SELECT *, 0.5 * 0.9 * (CASE WHEN least(sd, (q3 - q1) / 1.34) > 0 THEN least(sd, (q3 - q1) / 1.34)
                                  WHEN sd > 0 THEN sd WHEN abs(x1) > 0 THEN abs(x1) ELSE 1.0 END)
                   * pow(n, -0.2) AS bw
       FROM st),
grid AS (SELECT b.hatchery, b.release_group, b.n, b.bw, p.point,
                lim.lo + p.point * ((lim.hi - lim.lo) / 511) AS gx
         FROM bw b, lim, range(512) AS p(point))
SELECT g.hatchery, g.release_group, CAST(g.point AS INTEGER) AS point, round(g.gx, 6) AS x,
       round(COALESCE(sum(exp(-0.5 * ((g.gx - p.x) / g.bw) * ((g.gx - p.x) / g.bw)))
                      / (g.n * g.bw * sqrt(2 * pi())), 0.0), 6) AS density
FROM grid g LEFT JOIN pts p ON g.hatchery IS NOT DISTINCT FROM p.hatchery
                            AND g.release_group IS NOT DISTINCT FROM p.release_group
GROUP BY g.hatchery, g.release_group, g.point, g.gx, g.n, g.bw"""


SQL["timing_summary"] = with_(*juv_ctes(CHINOOK_SEL)).rstrip() + timing_sql("Chinook", "LGR")
SQL["b04_lines"] = with_(*juv_ctes(CHINOOK_SEL)).rstrip() + timing_sql("Chinook", "BONN")
SQL["b03"] = with_(*juv_ctes(CHINOOK_SEL)).rstrip() + density_sql("Chinook", "LGR")
SQL["b04"] = with_(*juv_ctes(CHINOOK_SEL)).rstrip() + density_sql("Chinook", "BONN")
SQL["group_kde"] = with_(*juv_ctes(STEELHEAD_SEL)).rstrip() + density_sql("Steelhead", "LGR")

ADULT_BIND = "SELECT * FROM (" + \
    "SELECT * FROM (" + SQL["season_dense"] + ") UNION ALL SELECT * FROM (" + SQL["season_dense_asof"] + ")" + \
    ") WHERE spawn_year >= 1999"
B05 = f"""SELECT * FROM ({ADULT_BIND})
WHERE dam = 'Lower Granite' AND species = 'Steelhead' AND spawn_year BETWEEN 1999 AND 2002"""
HATCHERIES = "('BUILDING', 'FURNITURE', 'MACHINERY')"

SQL["b05"] = B05
SQL["b06"] = f"""
SELECT hatchery, annual_total, CASE hatchery WHEN 'BUILDING' THEN 'Dworshak' WHEN 'FURNITURE' THEN 'Kooskia'
       WHEN 'MACHINERY' THEN 'Clearwater' ELSE hatchery END || ': ' || CAST(annual_total AS VARCHAR) AS label FROM (
  SELECT *, row_number() OVER (PARTITION BY hatchery ORDER BY running_total DESC, annual_total DESC,
                                                              dummy_date DESC) AS rn
  FROM ({B05}) WHERE spawn_year = 2002 AND hatchery IN {HATCHERIES} AND running_total IS NOT NULL)
WHERE rn = 1"""
SQL["b07"] = f"""
SELECT hatchery, CAST(sum(daily_total) AS BIGINT) AS new_count FROM ({B05})
WHERE spawn_year = 2002 AND hatchery IN {HATCHERIES}
  AND dayofyear(dummy_date) >= dayofyear(DATE '2001-07-08') AND dayofyear(dummy_date) <= dayofyear(DATE '2001-07-15')
GROUP BY hatchery"""
SQL["b08"] = f"""
SELECT hatchery, spawn_year, dummy_date, daily_total,
       ' Date: ' || strftime(dummy_date, '%B %d') || ' <br> Number Passed: ' || CAST(daily_total AS VARCHAR) AS label
FROM ({B05})"""
SQL["b09"] = f"""
SELECT hatchery, spawn_year, dummy_date, running_total,
       CASE WHEN spawn_year = CASE species WHEN 'Steelhead' THEN 2002 WHEN 'Chinook' THEN 2001 END
            THEN 'Current' ELSE 'Previous' END AS yr_category
FROM ({B05})"""

W_SEL = """
wsel AS (SELECT * FROM wdash WHERE spawn_year >= 1999 AND spawn_year <= (SELECT max(spawn_year) FROM wdash)
                              AND species = 'Summer Chinook' AND dam = 'Lower Granite')"""
WLIMITS = """
wlim AS (SELECT * FROM (VALUES
  ('Bonneville', 'Coho', DATE '1976-08-01', DATE '1976-12-31'),
  ('Lower Granite', 'Coho', DATE '1976-09-01', DATE '1976-12-31'),
  ('Bonneville', 'Spring Chinook', DATE '1976-03-14', DATE '1976-06-01'),
  ('Lower Granite', 'Spring Chinook', DATE '1976-04-14', DATE '1976-06-17'),
  ('Bonneville', 'Summer Chinook', DATE '1976-05-31', DATE '1976-08-02'),
  ('Lower Granite', 'Summer Chinook', DATE '1976-06-16', DATE '1976-08-17'),
  ('Bonneville', 'Fall Chinook', DATE '1976-08-01', DATE '1976-11-15'),
  ('Lower Granite', 'Fall Chinook', DATE '1976-08-16', DATE '1976-12-15'),
  ('Bonneville', 'Sockeye', DATE '1976-06-01', DATE '1976-08-10'),
  ('Lower Granite', 'Sockeye', DATE '1976-06-15', DATE '1976-10-15'),
  ('Bonneville', 'Steelhead', DATE '1976-07-01', DATE '1976-12-01'),
  ('Lower Granite', 'Steelhead', DATE '1976-07-01', DATE '1977-06-01')) AS t(dam, species, min_date, max_date))"""
WCTES = (WINDOW_ALL, W_SEL, WLIMITS)

SQL["b10"] = with_(*WCTES) + "SELECT * FROM wsel"
SQL["b11"] = with_(*WCTES) + """
SELECT date, dam, running_total, dam || ': ' || format('{:,}', CAST(running_total AS BIGINT)) AS label FROM (
  SELECT *, row_number() OVER (ORDER BY date DESC, dam DESC, running_total DESC) AS rn
  FROM wsel WHERE date IS NOT NULL) WHERE rn = 1"""
SQL["b12"] = with_(*WCTES) + \
    "SELECT dam, sum(count) AS lw_total FROM wsel WHERE date >= DATE '2001-07-08' GROUP BY dam"
SQL["b13"] = with_(*WCTES) + """
SELECT s.dam, s.species, s.spawn_year, s.date, s.dummy_date, s.count
FROM wsel s JOIN wlim l ON s.dam = l.dam AND s.species = l.species
WHERE s.spawn_year = (SELECT max(spawn_year) FROM wsel)
  AND s.dummy_date > l.min_date AND s.dummy_date < l.max_date"""
SQL["b14"] = with_(*WCTES) + """
SELECT s.dam, s.species, s.spawn_year, s.date, s.dummy_date, s.running_total,
       CASE WHEN s.spawn_year = c.cur_year THEN 'Current' ELSE 'Previous' END AS yr_category
FROM wsel s JOIN wlim l ON s.dam = l.dam AND s.species = l.species
LEFT JOIN cur_sy c ON s.species = c.species
WHERE s.dummy_date > l.min_date AND s.dummy_date < l.max_date"""

EMIG_ALL = "(" + SQL["emigration_all"] + ")"
SQL["b15"] = f"""
SELECT * FROM {EMIG_ALL}
WHERE release_year BETWEEN 1997 AND 2001 AND species = 'Chinook'
  AND (release_group IS NULL OR release_group NOT IN ('Powell', 'Red River', 'Selway River', 'Clear Creek'))"""


def _cmp_label(col: str, dam: str) -> str:
    return (f"' Release Year: ' || CAST(release_year AS VARCHAR) || ' <br> Release Dates: ' || earliest_release "
            f"|| ' - ' || latest_release || ' <br> Median Travel Time to {dam}: ' || CAST({col} AS VARCHAR) || ' days'")


SQL["b16"] = f"""
SELECT hatchery, release_year, release_group, median_lgr, median_bonn,
       {_cmp_label('median_lgr', 'LGR')} AS lgr_label, {_cmp_label('median_bonn', 'BONN')} AS bonn_label
FROM {EMIG_ALL}
WHERE release_year BETWEEN 1997 AND 2001 AND species = 'Steelhead'
  AND (release_group IS NULL OR release_group NOT IN ('Meadow Creek', 'Snake Kelts', 'Newsome Creek'))"""

SQL["b17"] = with_(GAUGE) + """
SELECT name, date, mean_discharge, mean_temp, round_even(mean_temp * 9.0 / 5.0 + 32.0, 1) AS mean_temp_f,
       'Discharge: ' || format('{:,.0f}', mean_discharge) || ' CFS' AS discharge_label
FROM (SELECT *, row_number() OVER (ORDER BY date DESC, sitenumber DESC, mean_temp DESC, mean_discharge DESC) AS rn
      FROM gauge WHERE name = 'Clearwater (Peck)' AND date IS NOT NULL) WHERE rn = 1"""
SQL["b18"] = with_(GAUGE) + """
SELECT "group", date, mean_discharge, mean_temp, round_even(mean_temp * 9.0 / 5.0 + 32.0, 1) AS mean_temp_f
FROM gauge WHERE name = 'Clearwater (Peck)'"""

SQL["b19"] = f"""
SELECT a.*, w.*, s.*, g.*, 'Chinook' AS default_adult_species,
       DATE '2001-01-01' AS min_date, DATE '2001-03-01' AS min_range_date
FROM (SELECT min(spawn_year) AS adult_min_sy, max(spawn_year) AS adult_max_sy FROM ({ADULT_BIND})) a,
     ({with_(WINDOW_ALL)} SELECT min(spawn_year) AS window_min_sy, max(spawn_year) - 1 AS window_max_sy,
              max(spawn_year) - 10 AS window_default_sy FROM wdash) w,
     (SELECT min(release_year) AS release_min_year, max(release_year) AS release_max_year,
             max(release_year) - 5 AS release_default_from FROM {EMIG_ALL}) s,
     ({with_(GAUGE)} SELECT array_to_string(list_sort(list_distinct(list(name))), ', ') AS gauge_sites FROM gauge) g"""
