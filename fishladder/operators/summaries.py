"""Group summaries over capture histories and data-quality tallies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fishladder.functions.dates import micros, month_day_label
from fishladder.operators.quantiles import bucket, quantiles_of_counts
from fishladder.operators.verbs import join_null_safe, union_all

SUMMARY_KEYS = ["hatchery", "species", "release_year", "release_group"]
SUMMARY_DAMS = ["LGR", "BONN"]


def stacked_counts(df: DataFrame, keys, measures: dict) -> DataFrame:
    """keys, _m, _v, _c: rows per group, measure and value (NULL included).

    ``measures`` maps name -> integer Column. All measures are stacked into
    one counted table, so ``df`` is read once for all of them."""
    pairs = F.array(*[F.struct(F.lit(name).alias("_m"), col.cast("long").alias("_v"))
                      for name, col in measures.items()])
    stacked = df.select(*keys, F.explode(pairs).alias("_s")).select(*keys, "_s._m", "_s._v")
    return stacked.groupBy(*keys, "_m", "_v").agg(F.count(F.lit(1)).alias("_c"))


def grouped_medians(df: DataFrame, keys, measures: dict, width=None) -> DataFrame:
    """Exact medians of several integer measures (name -> Column) in one pass."""
    keys = list(keys)
    counts = stacked_counts(df, keys, measures).where(F.col("_v").isNotNull())
    q = quantiles_of_counts(counts, keys + ["_m"], {"_med": 0.5}, width=width)
    return q.groupBy(*keys).agg(*[F.max(F.when(F.col("_m") == name, F.col("_med"))).alias(name)
                                  for name in measures])


DAY_MICROS = 86_400_000_000
# Days of a median's bucket: a group has some hundred buckets, so the table of buckets stays
# far smaller than the counts, and a bucket holds a small part of a group's values.
BUCKET_DAYS = 8


def summary_counts(hist: DataFrame, upper: str = "LGR", lower: str = "BONN", keys=None) -> DataFrame:
    """What ``emigration_summary`` needs of the histories, in one aggregation:
    rows per group, measure and value of travel days, arrival times and release days.
    Every history has a release row (also an undated one), so its missing days and
    times need none; Spark drops them before they are counted."""
    keys = SUMMARY_KEYS if keys is None else list(keys)
    counts = stacked_counts(hist, keys, {
        "_mu_t": F.col(f"{upper.lower()}_traveltime"), "_ml_t": F.col(f"{lower.lower()}_traveltime"),
        "_mu_d": micros(F.col(upper)), "_ml_d": micros(F.col(lower)),
        "_rel": F.datediff(F.col("release_date").cast("date"), F.lit("1970-01-01").cast("date"))})
    return counts.where((F.col("_m") == "_rel") | F.col("_v").isNotNull())


def emigration_summary(hist: DataFrame, upper: str = "LGR", lower: str = "BONN",
                       keys=None) -> DataFrame:
    """``summary_of_counts`` of the histories themselves."""
    return summary_of_counts(summary_counts(hist, upper, lower, keys), upper, lower, keys)


def _measure(m: str):
    return F.col("_m") == m


def _bucketed(counts: DataFrame) -> DataFrame:
    """``_b``: buckets of the medians, days of travel and of arrival; the release days are one bucket."""
    counts = counts.where(_measure("_rel") | F.col("_v").isNotNull())
    arrival = F.col("_m").isin("_mu_d", "_ml_d")
    return counts.withColumn("_b", F.when(arrival, bucket(F.col("_v"), BUCKET_DAYS * DAY_MICROS))
                             .when(~_measure("_rel"), bucket(F.col("_v"), BUCKET_DAYS)))


def _median_ranks():
    half = (F.col("_n") - 1) * F.lit(0.5)
    return half, F.floor(half) + 1, F.ceil(half) + 1


def median_buckets(counts: DataFrame, keys=None) -> DataFrame:
    """Of ``summary_counts``: the buckets that hold a group's medians, and its
    release row with detection counts and first/last days (nine rows a group at most)."""
    keys = SUMMARY_KEYS if keys is None else list(keys)
    is_, counts = _measure, _bucketed(counts)
    # one row per group, measure and bucket: everything but the medians, and where their ranks lie
    hist = counts.groupBy(*keys, "_m", "_b").agg(
        F.sum("_c").alias("_t"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"),
        F.count(F.when(F.col("_v").isNull(), 1)).alias("_nulls"))
    group, measure = Window.partitionBy(*keys), Window.partitionBy(*keys, "_m")
    upto = measure.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = lambda m: F.coalesce(F.sum(F.when(is_(m), F.col("_t"))).over(group), F.lit(0)).cast("long")
    rel = lambda agg, c: agg(F.when(is_("_rel"), F.col(c))).over(group)
    hist = hist.withColumns({
        "_before": F.sum("_t").over(upto) - F.col("_t"), "_n": F.sum("_t").over(measure),
        "_seen_u": seen("_mu_d"), "_seen_l": seen("_ml_d"), "_first": rel(F.min, "_lo"), "_last": rel(F.max, "_hi"),
        "_undated": rel(F.max, "_nulls")})
    _, lo_rank, hi_rank = _median_ranks()
    held = lambda r: (r > F.col("_before")) & (r <= F.col("_before") + F.col("_t"))
    # a group's release row carries its counts and dates through, also where there is no median
    return hist.where(is_("_rel") | held(lo_rank) | held(hi_rank)).drop("_lo", "_hi", "_nulls")


# Buckets of medians up to which their written table is broadcast.
BUCKET_ROWS = 500_000


def summary_of_counts(counts: DataFrame, upper: str = "LGR", lower: str = "BONN", keys=None,
                      buckets: DataFrame | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Per hatchery x species x release year x group: floor of the median
    travel days, date of the median arrival and detection count at the upper
    and lower dam, and the first/last release day as 'Month dd'.

    ``counts`` is ``summary_counts`` of the histories: counts, first and last
    days and all four medians come from that table, which is read twice.
    ``buckets`` is the written ``median_buckets`` table of the same counts where
    the caller keeps one; it is broadcast after its rows were counted, so the
    counts are not shuffled to find the few values beside the medians.
    """
    keys = SUMMARY_KEYS if keys is None else list(keys)
    lo_u, lo_l, is_ = upper.lower(), lower.lower(), _measure
    if buckets is None:
        buckets = median_buckets(counts, keys)
    elif buckets.count() <= bucket_rows:
        buckets = F.broadcast(buckets)
    half, lo_rank, hi_rank = _median_ranks()
    cells = join_null_safe(_bucketed(counts), buckets, keys + ["_m", "_b"])
    at = F.sum("_c").over(Window.partitionBy(*keys, "_m", "_b").orderBy("_v")
                          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cells = cells.withColumn("_upto", F.col("_before") + at)
    covers = lambda r: (r > F.col("_upto") - F.col("_c")) & (r <= F.col("_upto"))

    def median(m):
        lo, hi = (F.max(F.when(is_(m) & covers(r), F.col("_v"))).cast("double") for r in (lo_rank, hi_rank))
        return lo + F.max(F.when(is_(m), half - F.floor(half))) * (hi - lo)

    out = cells.groupBy(*keys).agg(
        *[median(m).alias(m) for m in ("_mu_t", "_ml_t", "_mu_d", "_ml_d")],
        *[F.max(c).alias(c) for c in ("_seen_u", "_seen_l", "_first", "_last", "_undated")])
    ts_date = lambda c: F.to_date(F.timestamp_micros(F.floor(F.col(c)).cast("long")))
    # min/max without na.rm: one undated release leaves both empty
    day = lambda c: F.when(F.col("_undated") == 0, month_day_label(
        F.date_add(F.lit("1970-01-01").cast("date"), F.col(c).cast("int"))))
    return out.select(
        *keys,
        F.floor("_mu_t").cast("long").alias(f"median_{lo_u}"),
        ts_date("_mu_d").alias(f"median_{lo_u}_date"),
        F.col("_seen_u").alias(f"{lo_u}_detections"),
        F.floor("_ml_t").cast("long").alias(f"median_{lo_l}"),
        ts_date("_ml_d").alias(f"median_{lo_l}_date"),
        F.col("_seen_l").alias(f"{lo_l}_detections"),
        day("_first").alias("earliest_release"), day("_last").alias("latest_release"))


def emigration_all(historical: DataFrame, current: DataFrame) -> DataFrame:
    """History summaries followed by the current season's (UNION ALL)."""
    return union_all(historical, current)


def tally(df: DataFrame, keys, name: str = "n") -> DataFrame:
    """Rows per group (dplyr tally)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
