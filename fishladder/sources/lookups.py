"""Literal lookup tables of the monitoring program.

FIXED VALUES. The site codes, dam names, label texts, dates and limits below
must equal the program's own tables for results to match; they are listed
plainly, in their natural order. Each table is tiny and bounded by
construction, which is what makes ``F.broadcast`` on them safe at any scale.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: dams -----------------------------------------------------

# Dam codes in river order (upstream first); this order is the column order
# of every wide history table.
DAM_LEVELS = ["LGR", "LGS", "LOMO", "ICH", "MCN", "JD", "TDA", "BONN", "TWX"]

# Site -> (dam name, dam code) used by the yearly history job.
DAM_KEY_HISTORY = [
    ("GRS", "Lower Granite", "LGR"), ("GRJ", "Lower Granite", "LGR"),
    ("GRA", "Lower Granite", "LGR"), ("LGR", "Lower Granite", "LGR"),
    ("LGRLDR", "Lower Granite", "LGR"),
    ("GOJ", "Little Goose", "LGS"), ("GOA", "Little Goose", "LGS"),
    ("LMJ", "Lower Monumental", "LOMO"), ("LMA", "Lower Monumental", "LOMO"),
    ("ICH", "Ice Harbor", "ICH"),
    ("MCJ", "McNary", "MCN"), ("MC2", "McNary", "MCN"),
    ("MC1", "McNary", "MCN"), ("MCN", "McNary", "MCN"),
    ("JDJ", "John Day", "JD"), ("JO1", "John Day", "JD"), ("JO2", "John Day", "JD"),
    ("TD1", "The Dalles", "TDA"), ("TD2", "The Dalles", "TDA"),
    ("B2J", "Bonneville", "BONN"), ("BCC", "Bonneville", "BONN"),
    ("BO1", "Bonneville", "BONN"), ("BO2", "Bonneville", "BONN"),
    ("BO4", "Bonneville", "BONN"), ("BONAFF", "Bonneville", "BONN"),
    ("TWX", "Estuary", "TWX"),
]

# The in-season job's shorter list (no LGR, LGRLDR, MCN, BONAFF).
DAM_KEY_INSEASON = [r for r in DAM_KEY_HISTORY
                    if r[0] not in ("LGR", "LGRLDR", "MCN", "BONAFF")]

# --- fixed values: adult passage sites ---------------------------------------

PASSAGE_SITES = {
    "Lower Granite": ["GRA", "LGRLDR"],
    "Bonneville": ["BO4", "BO3", "BO1", "BO2"],
    "Dworshak Ladder": ["DWL"],
}
# Which dams count a tag once per year (upper dam) or once per year and site.
PASSAGE_PER_SITE = {"Lower Granite": False, "Bonneville": True, "Dworshak Ladder": True}
KELT_GROUP = "Snake Kelts"
ADULT_OBS_TYPES = ["recapture", "passive recapture", "observation"]

# --- fixed values: release groups --------------------------------------------

NF = "North Fork Clearwater River"
# History rule rows: (sitecode, species or None, single-year test or None,
# release order or None, label). First matching row wins; no match -> NULL.
RELEASE_GROUP_RULES = [
    ("CLEARC", None, None, None, "Clear Creek"),
    ("CLWHNF", None, True, None, NF + " Single"),
    ("CLWHNF", None, False, 1, NF + " Early"),
    ("CLWHNF", None, False, 2, NF + " Late"),
    ("CLWRSF", None, None, None, "South Fork Clearwater River"),
    ("DWORMS", "Steelhead", None, None, "Clearwater River"),
    ("DWORMS", "Chinook", None, 1, "Clearwater River Early"),
    ("DWORMS", "Chinook", None, 2, "Clearwater River Late"),
    ("DWORNF", None, True, None, NF + " Single"),
    ("DWORNF", None, False, 1, NF + " Early"),
    ("DWORNF", None, False, 2, NF + " Late"),
    ("KOOS", None, None, None, "Kooskia"),
    ("LOLOC", None, None, None, "Lolo Creek"),
    ("MEAD2C", None, None, None, "Meadow Creek"),
    ("NEWSOC", None, None, None, "Newsome Creek"),
    ("POWP", None, None, None, "Powell"),
    ("REDP", None, None, None, "Red River"),
    ("SELWY1", None, None, None, "Selway River"),
    ("SNAKE2", None, None, None, "Snake Kelts"),
]
SINGLE_RELEASE_YEAR = 2020

# In-season rule rows: (sitecode, "early"/"late" date test or None, label).
RELEASE_GROUP_RULES_DATED = [
    ("DWORMS", None, "Clearwater River"),
    ("CLEARC", None, "Clear Creek"),
    ("CLWRSF", None, "South Fork Clearwater River"),
    ("NEWSOC", None, "Newsome Creek"),
    ("MEAD2C", None, "Meadow Creek"),
    ("KOOS", None, "Kooskia"),
    ("DWORNF", "early", NF + " Early"),
    ("DWORNF", "late", NF + " Late"),
    ("CLWHNF", "early", NF + " Early"),
    ("CLWHNF", "late", NF + " Late"),
    ("POWP", None, "Powell"),
    ("REDP", None, "Red River"),
    ("SELWY1", None, "Selway River"),
]
RELEASE_DATES_INSEASON = {"early": dt.date(2025, 3, 27), "late": dt.date(2025, 4, 10)}

# Release sites where fish are released on station (checked against upstream arrays).
ONSITE_RELEASE_CODES = ["DWORMS", "DWORNF"]

# Dashboard selections.
DASHBOARD_CHINOOK_GROUPS = [NF + " Early", NF + " Late", "Kooskia"]
COMPARISON_EXCLUDED = {
    "Chinook": ["Powell", "Red River", "Selway River", "Clear Creek"],
    "other": ["Meadow Creek", "Snake Kelts", "Newsome Creek"],
}
DASHBOARD_HATCHERIES = ["DWOR", "KOOS", "CLWH"]
HATCHERY_NAMES = {"DWOR": "Dworshak", "KOOS": "Kooskia", "CLWH": "Clearwater"}

# --- fixed values: seasons and calendars -------------------------------------

# Species whose current spawn year the in-season window job keeps.
WINDOW_SPECIES = ["Steelhead", "Chinook", "Bull Trout", "Chum", "Coho",
                  "Lamprey_Day", "Lamprey_Night", "Pink", "Shad", "Sockeye",
                  "Spring Chinook", "Summer Chinook", "Fall Chinook"]
ADULT_SPECIES = ["Steelhead", "Chinook"]

# (species, dam, last day of the plotted season on the dummy calendar).
SPECIES_MAX_DATES = [
    ("Chinook", "Lower Granite", dt.date(1976, 7, 15)),
    ("Steelhead", "Lower Granite", dt.date(1977, 5, 1)),
    ("Chinook", "Bonneville", dt.date(1976, 7, 15)),
    ("Steelhead", "Bonneville", dt.date(1977, 5, 1)),
    ("Chinook", "Dworshak Ladder", dt.date(1976, 9, 15)),
    ("Steelhead", "Dworshak Ladder", dt.date(1977, 5, 1)),
]

# (dam, species, min_date, max_date) on the dummy calendar; plots keep the
# open interval between them.
WINDOW_PLOT_LIMITS = [
    ("Bonneville", "Coho", dt.date(1976, 8, 1), dt.date(1976, 12, 31)),
    ("Lower Granite", "Coho", dt.date(1976, 9, 1), dt.date(1976, 12, 31)),
    ("Bonneville", "Spring Chinook", dt.date(1976, 3, 14), dt.date(1976, 6, 1)),
    ("Lower Granite", "Spring Chinook", dt.date(1976, 4, 14), dt.date(1976, 6, 17)),
    ("Bonneville", "Summer Chinook", dt.date(1976, 5, 31), dt.date(1976, 8, 2)),
    ("Lower Granite", "Summer Chinook", dt.date(1976, 6, 16), dt.date(1976, 8, 17)),
    ("Bonneville", "Fall Chinook", dt.date(1976, 8, 1), dt.date(1976, 11, 15)),
    ("Lower Granite", "Fall Chinook", dt.date(1976, 8, 16), dt.date(1976, 12, 15)),
    ("Bonneville", "Sockeye", dt.date(1976, 6, 1), dt.date(1976, 8, 10)),
    ("Lower Granite", "Sockeye", dt.date(1976, 6, 15), dt.date(1976, 10, 15)),
    ("Bonneville", "Steelhead", dt.date(1976, 7, 1), dt.date(1976, 12, 1)),
    ("Lower Granite", "Steelhead", dt.date(1976, 7, 1), dt.date(1977, 6, 1)),
]

# Dummy-calendar origins and the day-of-year season switch.
SPRING_ORIGIN = dt.date(1977, 1, 1)
AUTUMN_ORIGIN = dt.date(1976, 1, 1)
SEASON_SWITCH_DOY = 183

# Window-count report columns -> species names (in-season files carry two
# lamprey columns, finished-season files one).
WINDOW_COLUMNS_CURRENT = [
    ("Chin", "Chinook"), ("JChin", "Jack_Chinook"), ("Stlhd", "Steelhead"),
    ("WStlhd", "Wild_Steelhead"), ("Sock", "Sockeye"), ("Coho", "Coho"),
    ("JCoho", "Jack_Coho"), ("Shad", "Shad"), ("LmpryDay", "Lamprey_Day"),
    ("LmpryNight", "Lamprey_Night"), ("BTrout", "Bull Trout"),
    ("Chum", "Chum"), ("Pink", "Pink"),
]
WINDOW_COLUMNS_FINISHED = [
    ("Chin", "Chinook"), ("JChin", "Jack_Chinook"), ("Stlhd", "Steelhead"),
    ("WStlhd", "Wild_Steelhead"), ("Sock", "Sockeye"), ("Coho", "Coho"),
    ("JCoho", "Jack_Coho"), ("Shad", "Shad"), ("Lmpry", "Lamprey"),
    ("BTrout", "Bull Trout"), ("Chum", "Chum"), ("Pink", "Pink"),
]
CHINOOK_RUNS = [("Sp", "Spring"), ("Su", "Summer"), ("Fa", "Fall")]

# --- fixed values: gauges ------------------------------------------------------

GAUGE_SITES = [
    ("Clearwater (Peck)", "13341050"), ("Clearwater (Orofino)", "13340000"),
    ("Lolo Creek", "13339500"), ("SF Clearwater", "13338500"),
    ("Clear Creek", "13337095"), ("Selway", "13336500"), ("Lochsa", "13337000"),
]
GAUGE_PARAMETERS = {"00010": "mean_temp", "00060": "mean_discharge"}
GAUGE_START = dt.date(1990, 1, 1)

# --- fixed values: tag export ----------------------------------------------------

TAG_CHUNK_SIZE = 10000


# --- DataFrame builders ----------------------------------------------------------

def literal_df(spark: SparkSession, rows, schema) -> DataFrame:
    """A small literal table built inside the JVM plan.

    ``spark.createDataFrame(list)`` ships the rows through Python workers
    at execution time; here they become literals (one-row range + inline),
    so the table costs nothing at run time and its size is visible in the
    plan (the proven bound behind every ``F.broadcast`` of a lookup).
    """
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, st.fields)])
               for r in rows]
    if not structs:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in st.fields])
    return spark.range(1).select(F.inline(F.array(*structs)))


def dam_key_df(spark: SparkSession, rows=None, levels=None) -> DataFrame:
    """sitecode, dam, dam_code, dam_ord (position in the level list)."""
    rows = DAM_KEY_HISTORY if rows is None else rows
    levels = DAM_LEVELS if levels is None else levels
    schema = T.StructType([
        T.StructField("sitecode", T.StringType(), False),
        T.StructField("dam", T.StringType(), False),
        T.StructField("dam_code", T.StringType(), False),
        T.StructField("dam_ord", T.IntegerType(), False),
    ])
    return literal_df(spark, [(s, d, c, levels.index(c) + 1) for s, d, c in rows], schema)


def gauge_sites_df(spark: SparkSession, rows=None) -> DataFrame:
    rows = GAUGE_SITES if rows is None else rows
    return literal_df(spark, rows, "name string, sitenumber string")


def species_max_dates_df(spark: SparkSession, rows=None) -> DataFrame:
    rows = SPECIES_MAX_DATES if rows is None else rows
    return literal_df(spark, rows, "species string, dam string, max_date date")


def window_plot_limits_df(spark: SparkSession, rows=None) -> DataFrame:
    rows = WINDOW_PLOT_LIMITS if rows is None else rows
    return literal_df(spark, rows, "dam string, species string, min_date date, max_date date")
