"""Gaussian kernel density of arrival times per group, on a fixed grid.

What the dashboard draws: for every group (hatchery x release group) the
density of arrival times on ``n_grid`` equally spaced points between the axis
limits, using only arrivals inside the limits, bandwidth = ``adjust`` x the
normal reference rule ``0.9 * min(sd, IQR / 1.34) * n^-0.2`` (zero -> sd,
then |x|, then 1); groups with fewer than two arrivals are dropped.

The sum over all arrivals is a fast Gauss transform. A group's axis is cut
into cells one bandwidth wide; every arrival enters the ``TERMS`` moments of
its cell (sums, combined map-side), and a cell then acts on the grid through
its Hermite series instead of through each of its arrivals. With |t| <= 1/2
bandwidths from the cell's centre, term k is at most 1.09 * 0.5^k / sqrt(k!)
per arrival (Cramer's bound), so what is cut off is below 1e-15 of the kernel's
peak; nothing is dropped. A cell has no effect in double precision beyond
``REACH`` bandwidths (exp(-REACH^2 / 2) is zero), so it is spread over the grid
points within that reach only.

Rows: distinct times -> cells (axis / bandwidth at most, whatever the number
of arrivals) -> grid points. Count, spread and quartiles come from buckets of
the axis (``BUCKETS`` at most per group), and only the buckets that hold a
quartile are looked at value by value: no group is gathered in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fishladder.operators.verbs import join_null_safe

SQRT_2PI = math.sqrt(2.0 * math.pi)
TERMS = 20
REACH = 39.0
BUCKETS = 4096


def hermite(terms: int) -> list[list[int]]:
    """Coefficients (lowest power first) of the polynomials He_0 .. He_(terms-1):
    He_(k+1)(z) = z He_k(z) - k He_(k-1)(z)."""
    out = [[1], [0, 1]]
    for k in range(1, terms - 1):
        up, down = [0, *out[k]], out[k - 1] + [0, 0]
        out.append([a - k * b for a, b in zip(up, down)])
    return out[:terms]


def group_statistics(points: DataFrame, keys) -> DataFrame:
    """keys, _n, _sd, _iqr, _x1 (smallest value) of counted values ``_x``, ``_c``
    between ``_lo`` and ``_hi``, and the two limits."""
    width = (F.col("_hi") - F.col("_lo")) / BUCKETS
    cell = F.when(width > 0, F.floor((F.col("_x") - F.col("_lo")) / width)).otherwise(F.lit(0)).cast("long")
    points = points.withColumns({"_b": cell, "_e": F.col("_x") - F.col("_lo") - cell * width})
    c, e, t = F.col("_c"), F.col("_e"), F.col("_t")
    hist = points.groupBy(*keys, "_b").agg(
        F.sum("_c").alias("_t"), F.sum(c * e).alias("_s1"), F.sum(c * e * e).alias("_s2"), F.min("_x").alias("_x1"),
        F.max("_x").alias("_x2"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
    group = Window.partitionBy(*keys)                        # BUCKETS rows at most
    upto = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = hist.withColumns({"_n": F.sum("_t").over(group), "_before": F.sum("_t").over(upto) - t,
                             "_m": F.col("_b") * width + F.col("_s1") / t})
    hist = hist.withColumn("_mean", F.sum(t * F.col("_m")).over(group) / F.col("_n"))
    inside = F.greatest(F.col("_s2") - F.col("_s1") * F.col("_s1") / t, F.lit(0.0))
    far = F.col("_m") - F.col("_mean")
    spread = F.sum(inside + t * far * far).over(group) / (F.col("_n") - 1)
    first, last = F.min("_x1").over(group), F.max("_x2").over(group)
    hist = hist.withColumns({"_sd": F.when(first == last, F.lit(0.0)).otherwise(F.sqrt(spread)), "_x1": first})

    ranks = {}
    for name, p in (("_q1", 0.25), ("_q3", 0.75)):
        h = (F.col("_n") - 1) * F.lit(p)
        ranks[name] = (F.floor(h) + 1, F.ceil(h) + 1, h - F.floor(h))
    held = lambda r: (r > F.col("_before")) & (r <= F.col("_before") + F.col("_t"))
    wanted = [held(r) for lo, hi, _ in ranks.values() for r in (lo, hi)]
    target = hist.where((F.col("_n") >= 2) & (wanted[0] | wanted[1] | wanted[2] | wanted[3]))
    target = target.select(*keys, "_b", "_before", "_n", "_sd", "_x1", "_lo", "_hi")
    cells = join_null_safe(points.select(*keys, "_b", "_x", "_c"), target, [*keys, "_b"])
    seen = F.col("_before") + F.sum("_c").over(Window.partitionBy(*keys, "_b").orderBy("_x").rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    cells = cells.withColumn("_upto", seen)
    covers = lambda r: (r > F.col("_upto") - F.col("_c")) & (r <= F.col("_upto"))

    def quantile(name):
        lo, hi, part = ranks[name]
        a, b = (F.max(F.when(covers(r), F.col("_x"))) for r in (lo, hi))
        return a + F.max(part) * (b - a)

    return cells.groupBy(*keys).agg(*[F.max(x).alias(x) for x in ("_n", "_sd", "_x1", "_lo", "_hi")],
                                    (quantile("_q3") - quantile("_q1")).alias("_iqr"))


def bandwidth(adjust: float) -> Column:
    low = F.least(F.col("_sd"), F.col("_iqr") / 1.34)
    base = (F.when(low > 0, low).when(F.col("_sd") > 0, F.col("_sd"))
             .when(F.abs("_x1") > 0, F.abs("_x1")).otherwise(F.lit(1.0)))
    return F.lit(adjust) * 0.9 * base * F.pow(F.col("_n").cast("double"), -0.2)


def group_kde(df: DataFrame, keys, value: str, limits: DataFrame, n_grid: int = 512,
              adjust: float = 0.5, weight: str | None = None) -> DataFrame:
    """Density per group at ``n_grid`` points from ``lo`` to ``hi``.

    ``value`` is a numeric column (e.g. epoch days), ``weight`` a column of
    counts where ``df`` is counted already (one row per group and value);
    ``limits`` is a one-row DataFrame with columns ``lo`` and ``hi`` in the same
    unit (an aggregate of the data, so no value passes through the driver).
    Output: keys, point (0-based), x, density.
    """
    keys = list(keys)
    lim = F.broadcast(limits.select(F.col("lo").cast("double").alias("_lo"),
                                    F.col("hi").cast("double").alias("_hi"),
                                    F.lit(1).alias("_k")))
    x = F.col(value).cast("double").alias("_x")
    times = (df.select(*keys, x, F.col(weight).alias("_c")) if weight
             else df.groupBy(*keys, x).agg(F.count(F.lit(1)).alias("_c")))
    pts = (times.withColumn("_k", F.lit(1)).join(lim, "_k").drop("_k")
                .where((F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi"))))
    stats = group_statistics(pts, keys).select(*keys, "_n", "_lo", "_x1", bandwidth(adjust).alias("_bw"),
                                               ((F.col("_hi") - F.col("_lo")) / (n_grid - 1)).alias("_step"))

    # moments of the arrivals about the centres of their cells
    own = join_null_safe(pts.select(*keys, "_x", "_c"), stats, keys)
    own = own.withColumn("_cell", F.expr("CAST(floor((_x - _lo) / _bw) AS BIGINT)"))
    own = own.withColumn("_u", F.expr("(_x - (_lo + (_cell + 0.5D) * _bw)) / _bw"))
    cells = own.groupBy(*keys, "_n", "_lo", "_bw", "_step", "_cell").agg(
        F.max(F.col("_x") == F.col("_x1")).alias("_first"),
        *[F.expr(f"sum(_c * pow(_u, {k}D) / {float(math.factorial(k))!r}D)").alias(f"_m{k}") for k in range(TERMS)])

    # the series of a cell as one polynomial (sum over k of He_k(z) m_k), on the points it reaches; the
    # group's first cell is spread over the whole grid, so that every point has a row
    table = hermite(TERMS)
    series = [" + ".join(f"{float(table[k][j])!r}D * _m{k}" for k in range(j, TERMS, 2)) for j in range(TERMS)]
    far = n_grid - 1
    first = f"greatest(0D, ceil(((_cell + 0.5D) * _bw - {REACH}D * _bw) / _step))"
    last = f"least({far}D, floor(((_cell + 0.5D) * _bw + {REACH}D * _bw) / _step))"
    all_points = "_first OR _step = 0D"
    cells = cells.where(F.expr(f"{all_points} OR {first} <= {last}"))
    spread = cells.select(
        *keys, "_n", "_lo", "_bw", "_step", "_cell", *[F.expr(a).alias(f"_a{j}") for j, a in enumerate(series)],
        F.explode(F.expr(f"CASE WHEN {all_points} THEN sequence(0, {far}) "
                         f"ELSE sequence(CAST({first} AS INT), CAST({last} AS INT)) END")).alias("point"))
    spread = spread.withColumn("_z", F.expr("(point * _step - (_cell + 0.5D) * _bw) / _bw"))
    value_at = f"_a{TERMS - 1}"
    for j in range(TERMS - 2, -1, -1):
        value_at = f"({value_at} * _z + _a{j})"
    spread = spread.withColumn("_d", F.expr(
        f"CASE WHEN abs(_z) <= {REACH}D THEN exp(-0.5D * _z * _z) * {value_at} ELSE 0D END"))
    at = F.col("_lo") + F.col("point") * F.col("_step")
    total = F.sum("_d") / (F.first("_n") * F.first("_bw") * SQRT_2PI)
    return spread.groupBy(*keys, "point", at.alias("x")).agg(F.greatest(total, F.lit(0.0)).alias("density"))
