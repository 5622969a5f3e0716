"""River gauge daily values: stacking, naming, the last year, latest reading."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fishladder.functions.dates import to_fahrenheit
from fishladder.operators.verbs import last_by


def gauge_year(daily_raw: DataFrame, sites: DataFrame, as_of: dt.date) -> DataFrame:
    """Rename parameter columns, add year and site name (broadcast
    lookup), keep readings from one year before ``as_of`` on (Q14:
    ``add_months(-12)`` maps 29 Feb to 28 Feb)."""
    d = daily_raw.select(F.col("site_no").alias("sitenumber"), F.col("Date").cast("date").alias("date"),
                         F.col("X_00010_00003").alias("mean_temp"),
                         F.col("X_00060_00003").alias("mean_discharge"))
    d = d.withColumn("year", F.year("date"))
    d = d.join(F.broadcast(sites.select("sitenumber", "name")), "sitenumber", "left")
    since = F.add_months(F.lit(as_of), -12)
    return (d.where(F.col("date") >= since).withColumn("group", F.col("sitenumber"))
             .select("sitenumber", "date", "mean_temp", "mean_discharge", "year", "name", "group"))


def latest_reading(gauges: DataFrame, keys=("name",)) -> DataFrame:
    """Last date per site name (its temperature may be NULL), with °F."""
    last = last_by(gauges, list(keys), ["date"], ["sitenumber", "mean_temp", "mean_discharge"])
    return last.withColumn("mean_temp_f", F.bround(to_fahrenheit("mean_temp"), 1))
