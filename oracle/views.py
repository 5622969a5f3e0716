"""Domain views over the driver tables, written in DuckDB SQL from the role
description (not from the Spark code), as WITH-clause fragments."""

DAMS = ["LGR", "LGS", "LOMO", "ICH", "MCN", "JD", "TDA", "BONN", "TWX"]

MARKS0 = """
marks0 AS (
  SELECT o.o_orderkey AS pit_id,
         c.c_mktsegment AS hatchery,
         CAST(o.o_orderdate AS DATE) AS mark_date,
         s.code || ' RELEASE SITE' AS release_site,
         s.code AS release_sitecode,
         CASE WHEN o.o_orderkey % 97 = 0 THEN NULL
              ELSE CAST(date_trunc('quarter', o.o_orderdate) AS DATE) END AS release_date,
         CASE WHEN o.o_orderkey % 50 = 0 THEN 'Adult' ELSE 'Juvenile' END AS mark_lifestage,
         CASE o.o_orderstatus WHEN 'F' THEN 'Steelhead' WHEN 'O' THEN 'Chinook'
                              WHEN 'P' THEN 'Coho' END AS species,
         o.o_totalprice AS length_mm,
         c.c_name AS tag_file
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN (VALUES ('1','DWORNF'),('2','CLWHNF'),('3','DWORMS'),('4','KOOS'),('5','SNAKE2'))
       AS s(k, code) ON substr(o.o_orderpriority, 1, 1) = s.k
)"""

# release order = rank of the distinct release date inside
# (hatchery, species, site, year); NULL dates form their own year group.
MARKS_ORDERED = MARKS0 + """,
marks_ord AS (
  SELECT *, CAST(year(release_date) AS INTEGER) AS release_year,
         CAST(dense_rank() OVER (PARTITION BY hatchery, species, release_sitecode, year(release_date)
                                 ORDER BY release_date) AS INTEGER) AS release_order
  FROM marks0
)"""

NF = "North Fork Clearwater River"
MARKS = MARKS_ORDERED + f""",
marks AS (
  SELECT pit_id, hatchery, mark_date, release_site, release_sitecode, release_date,
         mark_lifestage, species, length_mm, tag_file, release_year,
    CASE
      WHEN release_sitecode = 'CLEARC' THEN 'Clear Creek'
      WHEN release_sitecode IN ('CLWHNF', 'DWORNF') AND release_year = 1996 THEN '{NF} Single'
      WHEN release_sitecode IN ('CLWHNF', 'DWORNF') AND release_year <> 1996 AND release_order = 1 THEN '{NF} Early'
      WHEN release_sitecode IN ('CLWHNF', 'DWORNF') AND release_year <> 1996 AND release_order = 2 THEN '{NF} Late'
      WHEN release_sitecode = 'CLWRSF' THEN 'South Fork Clearwater River'
      WHEN release_sitecode = 'DWORMS' AND species = 'Steelhead' THEN 'Clearwater River'
      WHEN release_sitecode = 'DWORMS' AND species = 'Chinook' AND release_order = 1 THEN 'Clearwater River Early'
      WHEN release_sitecode = 'DWORMS' AND species = 'Chinook' AND release_order = 2 THEN 'Clearwater River Late'
      WHEN release_sitecode = 'KOOS' THEN 'Kooskia'
      WHEN release_sitecode = 'LOLOC' THEN 'Lolo Creek'
      WHEN release_sitecode = 'MEAD2C' THEN 'Meadow Creek'
      WHEN release_sitecode = 'NEWSOC' THEN 'Newsome Creek'
      WHEN release_sitecode = 'POWP' THEN 'Powell'
      WHEN release_sitecode = 'REDP' THEN 'Red River'
      WHEN release_sitecode = 'SELWY1' THEN 'Selway River'
      WHEN release_sitecode = 'SNAKE2' THEN 'Snake Kelts'
    END AS release_group
  FROM marks_ord
)"""

OBS_TIME = "(CAST(l_shipdate AS TIMESTAMP) + to_minutes(CAST(l_suppkey AS INTEGER)))"

# tag-history detections, mark events removed
DET = f"""
det AS (
  SELECT l_orderkey AS pit_id,
         CASE l_returnflag WHEN 'A' THEN 'observation' WHEN 'N' THEN 'recapture' END AS obs_type,
         {OBS_TIME} AS obs_datetime,
         CAST({OBS_TIME} AS DATE) AS obs_date,
         CAST(year({OBS_TIME}) AS INTEGER) AS obs_year,
         'S' || CAST(l_linenumber AS VARCHAR) AS obs_sitecode
  FROM lineitem WHERE l_returnflag <> 'R'
)"""

# in-season report rows
REPORT = f"""
report AS (
  SELECT l_orderkey AS pit_id, {OBS_TIME} AS obs_datetime,
         'S' || CAST(l_linenumber AS VARCHAR) || ' ARRAY' AS site,
         'S' || CAST(l_linenumber AS VARCHAR) AS sitecode
  FROM lineitem
)"""

DAMKEY = """
damkey AS (
  SELECT * FROM (VALUES ('S1','Lower Granite','LGR'), ('S2','Lower Granite','LGR'),
                        ('S3','Little Goose','LGS'), ('S4','McNary','MCN'),
                        ('S5','Bonneville','BONN'), ('S6','Bonneville','BONN'))
         AS t(sitecode, dam, dam_code)
)"""

UPSTREAM = """
upstream AS (SELECT DISTINCT l_orderkey AS pit_id FROM lineitem WHERE l_linenumber = 6)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(p.strip().rstrip(",") for p in parts) + "\n"


def wide_min(col: str, alias_prefix: str = "") -> str:
    return ", ".join(f"min({col}) FILTER (WHERE dam_code = '{d}') AS {alias_prefix}{d}" for d in DAMS)


def flags_and_times(release_ts: str) -> str:
    flags = ", ".join(f"CASE WHEN {d} IS NULL THEN '0' ELSE '1' END AS {d}_ch" for d in DAMS)
    times = ", ".join(f"epoch({d}) AS {d}_time" for d in DAMS)
    travel = ", ".join(
        f"CAST(floor((epoch({d}) - epoch({release_ts})) / 86400.0) AS BIGINT) AS {d.lower()}_traveltime"
        for d in DAMS)
    return f"{flags}, epoch({release_ts}) AS release_time, {times}, {travel}"


def history_select(release_date_expr: str = "release_date", group: bool = True) -> str:
    ids = ["pit_id", "species", "tag_file", "hatchery", f"{release_date_expr} AS release_date",
           "release_year", "mark_date", "release_sitecode"] + (["release_group"] if group else []) + ["length_mm"]
    cols = (ids + DAMS + [f"{d}_ch" for d in DAMS] + ["release_time"] + [f"{d}_time" for d in DAMS]
            + [f"{d.lower()}_traveltime" for d in DAMS])
    return ", ".join(cols)
