"""Exact grouped quantiles that never gather a group into one task.

``percentile``/``median`` keep a value->count map per group inside a single
aggregation buffer, so a release group holding a third of all tags would land
in one task. Here equal values are counted first (combined map-side), and
values fall into order-preserving buckets by a deterministic expression of the
value alone. The bucket totals of a group give each wanted rank its bucket;
only those buckets are numbered value by value. No partition ids, no sampled
bounds: the result does not depend on how Spark plans or reuses a shuffle. It
is R / DuckDB ``quantile_cont`` (type 7): ``v[lo] + frac * (v[hi] - v[lo])``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fishladder.operators.verbs import join_null_safe


def value_counts(df: DataFrame, keys, value) -> DataFrame:
    """keys, _v, _c: rows per group and non-NULL value."""
    v = F.col(value) if isinstance(value, str) else value
    return (df.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull())
              .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")))


def bucket(v: Column, width=None) -> Column:
    """Order-preserving bucket of a number: ``floor(v / width)``, or without a
    width 32 steps per power of two (mirrored for negative values)."""
    if width is not None:
        return F.floor(v / width).cast("long")
    step = 100_000 + F.floor(F.log2(F.abs(v).cast("double")) * 32).cast("long")
    return F.when(v == 0, F.lit(0).cast("long")).when(v > 0, step).otherwise(-step)


def _wanted(probs: dict, n: Column) -> Column:
    """The (1-based) ranks each probability needs in a group of ``n`` rows."""
    out = []
    for name, p in probs.items():
        h = (n - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(h) + 1), ("hi", F.ceil(h) + 1)):
            out.append(F.struct(F.lit(name).alias("q"), F.lit(side).alias("side"), rank.cast("long").alias("rank"),
                                (h - F.floor(h)).alias("frac")))
    return F.array(*out)


def quantiles_of_counts(counts: DataFrame, keys, probs: dict, count_name: str | None = None,
                        width=None) -> DataFrame:
    """``grouped_quantiles`` of a counted table (keys, _v, _c)."""
    keys = list(keys)
    counts = counts.withColumn("_b", bucket(F.col("_v"), width))
    # one row per (group, bucket): prefix sums over buckets, never over rows
    hist = counts.groupBy(*keys, "_b").agg(F.sum("_c").alias("_t"))
    group = Window.partitionBy(*keys)
    hist = hist.withColumns({
        "_before": F.sum("_t").over(group.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_t"),
        "_n": F.sum("_t").over(group)})
    held = F.exists(_wanted(probs, F.col("_n")), lambda r: (r["rank"] > F.col("_before"))
                    & (r["rank"] <= F.col("_before") + F.col("_t")))
    target = hist.where(held).select(*keys, "_b", "_before", "_n")    # at most two buckets per group and probability

    cells = join_null_safe(counts, target, keys + ["_b"])
    upto = F.sum("_c").over(Window.partitionBy(*keys, "_b").orderBy("_v")
                            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cells = cells.withColumn("_upto", F.col("_before") + upto)
    covered = F.filter(_wanted(probs, F.col("_n")), lambda r: (r["rank"] > F.col("_upto") - F.col("_c"))
                       & (r["rank"] <= F.col("_upto")))
    hits = cells.select(*keys, "_n", F.col("_v").cast("double").alias("_v"), F.explode(covered).alias("_r"))

    pick = lambda name, side, col: F.max(F.when((F.col("_r.q") == name) & (F.col("_r.side") == side), F.col(col)))
    aggs = []
    for name in probs:
        lo, hi = pick(name, "lo", "_v"), pick(name, "hi", "_v")
        aggs.append((lo + pick(name, "lo", "_r.frac") * (hi - lo)).alias(name))
    if count_name:
        aggs.append(F.max("_n").alias(count_name))
    return hits.groupBy(*keys).agg(*aggs)


def grouped_quantiles(df: DataFrame, keys, value, probs: dict, count_name: str | None = None,
                      width=None) -> DataFrame:
    """Exact interpolated quantiles of ``value`` per ``keys``.

    ``value`` is a column name or Column of a numeric type (convert
    timestamps with ``functions.dates.micros`` first). ``probs`` maps output column name
    to probability; ``width`` is the bucket width (a number or a Column over the
    keys) where the caller knows the grain. NULL values are ignored; groups
    without values are absent. Output: keys + one double column per prob
    (+ ``count_name`` if given).
    """
    keys = list(keys)
    return quantiles_of_counts(value_counts(df, keys, value), keys, probs, count_name, width)
