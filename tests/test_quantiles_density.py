import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fishladder.operators.chunks import number_rows, tag_chunks
from fishladder.operators.density import group_kde
from fishladder.operators.quantiles import grouped_quantiles
from fishladder.operators.summaries import grouped_medians


def test_grouped_quantiles_match_numpy_with_hot_group(spark):
    rnd = random.Random(7)
    data = [("hot", float(rnd.randint(0, 500))) for _ in range(3000)]          # a third of all rows and more
    data += [(f"g{i % 40}", rnd.gauss(0, 10)) for i in range(2500)]
    data += [(None, 1.0), (None, 4.0), ("single", 3.5), ("nulls", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(7)
    probs = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    got = {r["g"]: r for r in grouped_quantiles(df, ["g"], "v", probs, count_name="n").collect()}
    groups = {}
    for g, v in data:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)  # all-NULL group absent
    for g, vals in groups.items():
        for name, p in probs.items():
            assert math.isclose(got[g][name], float(np.quantile(vals, p)), rel_tol=1e-12, abs_tol=1e-9), (g, name)
        assert got[g]["n"] == len(vals)


def test_grouped_medians_stacked(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, None), ("a", 4, 30), ("b", None, 5)], "k string, x long, y long")
    got = {r["k"]: (r["mx"], r["my"]) for r in grouped_medians(df, ["k"], {"mx": F.col("x"), "my": F.col("y")}).collect()}
    assert got == {"a": (2.0, 20.0), "b": (None, 5.0)}


def _kde_brute(xs, lo, hi, n=512, adjust=0.5):
    xs = np.array([x for x in xs if lo <= x <= hi])
    sd = xs.std(ddof=1)
    iqr = np.quantile(xs, 0.75) - np.quantile(xs, 0.25)
    base = min(sd, iqr / 1.34) or sd or abs(xs.min()) or 1.0
    bw = adjust * 0.9 * base * len(xs) ** -0.2
    grid = np.linspace(lo, hi, n)
    z = (grid[:, None] - xs[None, :]) / bw
    return grid, np.exp(-0.5 * z * z).sum(axis=1) / (len(xs) * bw * math.sqrt(2 * math.pi))


def test_group_kde_matches_brute_force(spark):
    rnd = random.Random(3)
    a = [rnd.gauss(100, 5) for _ in range(400)] + [100.0] * 50
    b = [rnd.gauss(110, 2) for _ in range(60)] + [300.0]
    df = spark.createDataFrame([("a", x) for x in a] + [("b", x) for x in b] + [("c", 105.0)], "g string, x double")
    lim = spark.createDataFrame([(80.0, 130.0)], "lo double, hi double")
    out = group_kde(df, ["g"], "x", lim, n_grid=128)
    got = {}
    for r in out.collect():
        got.setdefault(r["g"], {})[r["point"]] = (r["x"], r["density"])
    assert set(got) == {"a", "b"}  # fewer than two points -> dropped
    for g, xs in (("a", a), ("b", b)):
        grid, dens = _kde_brute(xs, 80.0, 130.0, n=128)
        for i in range(128):
            assert math.isclose(got[g][i][0], grid[i], rel_tol=1e-12)
            assert abs(got[g][i][1] - dens[i]) < 1e-12
        assert abs(np.trapezoid(dens, grid) - 1.0) < 0.02


def test_hermite_coefficients():
    from fishladder.operators.density import hermite
    assert hermite(5) == [[1], [0, 1], [-1, 0, 1], [0, -3, 0, 1], [3, 0, -6, 0, 1]]


@pytest.mark.parametrize("shape", ["wide", "narrow", "lumps", "equal", "two", "outlier", "ends"])
def test_moments_equal_the_full_sum(spark, shape):
    """Fast Gauss transform against every arrival on every grid point."""
    rnd = random.Random(shape)
    xs = {"wide": [rnd.uniform(0, 365) for _ in range(3000)],
          "narrow": [200 + rnd.gauss(0, 1e-3) for _ in range(2000)],                     # far below the grid's step
          "lumps": [float(rnd.choice([10, 11, 12, 300])) for _ in range(900)],
          "equal": [77.25] * 40, "two": [5.0, 250.5],
          "outlier": [100 + rnd.gauss(0, 0.5) for _ in range(500)] + [360.0],
          "ends": [0.0] * 30 + [365.0] * 30 + [rnd.uniform(0, 365) for _ in range(50)]}[shape]
    counted = spark.createDataFrame([(None, x) for x in xs], "g string, x double").repartition(4)
    lim = spark.createDataFrame([(0.0, 365.0)], "lo double, hi double")
    got = {r["point"]: r for r in group_kde(counted, ["g"], "x", lim).collect()}
    weighted = counted.groupBy("g", "x").count()
    again = {r["point"]: r["density"] for r in group_kde(weighted, ["g"], "x", lim, weight="count").collect()}
    v = np.array(xs)
    iqr = np.quantile(v, 0.75) - np.quantile(v, 0.25)
    sd = 0.0 if v.min() == v.max() else v.std(ddof=1)
    bw = 0.45 * (min(sd, iqr / 1.34) or sd or abs(v.min()) or 1.0) * len(v) ** -0.2
    grid = np.linspace(0.0, 365.0, 512)
    z = (grid[:, None] - v[None, :]) / bw
    peak = 1 / (bw * math.sqrt(2 * math.pi))
    want = peak * np.exp(-0.5 * z * z).mean(axis=1)
    assert len(got) == 512 and all(r["g"] is None for r in got.values())
    for i in range(512):
        assert math.isclose(got[i]["x"], grid[i], rel_tol=1e-12)
        assert abs(got[i]["density"] - want[i]) < 1e-12 * max(1.0, peak), (i, got[i]["density"], want[i])
        assert abs(again[i] - want[i]) < 1e-12 * max(1.0, peak)


def test_no_row_of_an_arrival_becomes_a_grid(spark):
    """Rows made for the grid grow with the axis in bandwidths, not with the arrivals."""
    from fishladder.operators.density import group_kde as kde
    few, many = (spark.range(n).select(F.lit("g").alias("g"), (F.col("id") * 365.0 / n).alias("x")) for n in (2000, 40000))
    lim = spark.createDataFrame([(0.0, 365.0)], "lo double, hi double")

    def spread(df):
        out = kde(df, ["g"], "x", lim)
        out.collect()
        rows = []

        def walk(node):
            if node.nodeName() == "Generate" and node.metrics().contains("numOutputRows"):
                rows.append(node.metrics().apply("numOutputRows").value())
            for plan in ([node.executedPlan()] if node.nodeName() == "AdaptiveSparkPlan" else []):
                walk(plan)
            if node.nodeName().endswith("QueryStage"):
                walk(node.plan())
            kids = node.children()
            for i in range(kids.size()):
                walk(kids.apply(i))
        walk(out._jdf.queryExecution().executedPlan())
        return max(rows)
    assert spread(many) < 3 * spread(few)


def test_tag_chunks_25000(spark):
    ids = spark.range(25000).select(F.format_string("3D9.%08d", (F.col("id") * 7919) % 25000).alias("pit_id"))
    ch = tag_chunks(ids.repartition(5))
    sizes = {r["chunk"]: r["count"] for r in ch.groupBy("chunk").count().collect()}
    assert sizes == {1: 10000, 2: 10000, 3: 5000}
    first = ch.where(F.col("chunk") == 1).agg(F.max("pit_id")).collect()[0][0]
    second = ch.where(F.col("chunk") == 2).agg(F.min("pit_id")).collect()[0][0]
    assert first < second  # ids in stable (sorted) order


def test_number_rows_is_dense(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k")).repartition(4)
    idx = sorted(r["row_index"] for r in number_rows(df, "k").collect())
    assert idx == list(range(1000))


def test_small_domain_quantiles_match_numpy(spark):
    rnd = random.Random(11)
    data = [("hot", rnd.randint(-5, 60)) for _ in range(4000)] + [(f"g{i % 9}", rnd.randint(0, 9)) for i in range(300)]
    data += [(None, 3), (None, 8), ("one", 7), ("nulls", None)]
    df = spark.createDataFrame(data, "g string, v long").repartition(5)
    probs = {"q25": 0.25, "q50": 0.5, "q90": 0.9}
    got = {r["g"]: r for r in grouped_quantiles(df, ["g"], "v", probs, width=1).collect()}
    groups = {}
    for g, v in data:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, vals in groups.items():
        for name, p in probs.items():
            assert math.isclose(got[g][name], float(np.quantile(vals, p)), abs_tol=1e-9), (g, name)


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return fn()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


SMALL = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB"}


def test_numbers_are_unique_in_a_union(spark):
    """The outer read shares a stage with another shuffle here."""
    def run():
        n = number_rows(spark.range(40000).select((F.col("id") * 7919 % 40000).alias("k")), "k")
        big = spark.range(400000).select(F.col("id").alias("k"), (F.col("id") + 1_000_000).alias("row_index")).repartition("k")
        got = n.unionByName(big).where("row_index < 1000000").select("k", "row_index").collect()
        assert sorted((r[0], r[1]) for r in got) == [(i, i) for i in range(40000)]
    _with_conf(spark, SMALL, run)


def test_repeated_values_get_a_number_each(spark):
    df = spark.createDataFrame([(5,)] * 3000 + [(1,), (None,), (9,)], "k long")
    got = sorted((r[1], r[0]) for r in number_rows(df, "k").collect())
    assert got == [(0, None), (1, 1)] + [(i + 2, 5) for i in range(3000)] + [(3002, 9)]


def test_quantiles_do_not_depend_on_exchange_reuse(spark):
    rnd = random.Random(5)
    data = [(f"g{i % 3}", rnd.randint(-10**6, 10**9)) for i in range(6000)]
    df = spark.createDataFrame(data, "g string, v long").repartition(9)
    want = {g: float(np.quantile([v for k, v in data if k == g], 0.5)) for g in ("g0", "g1", "g2")}
    for conf in ({"spark.sql.exchange.reuse": "false"}, SMALL, {**SMALL, "spark.sql.exchange.reuse": "false"}):
        for width in (None, 1000):
            def run():
                q = grouped_quantiles(df, ["g"], "v", {"m": 0.5}, width=width)
                assert {r["g"]: r["m"] for r in q.collect()} == want
                u = q.unionByName(spark.range(50000).select(F.lit("x").alias("g"), F.col("id").cast("double").alias("m")).repartition("m"))
                assert {r["g"]: r["m"] for r in u.where("g != 'x'").collect()} == want
            _with_conf(spark, conf, run)


def test_bucket_keeps_the_order(spark):
    from fishladder.operators.quantiles import bucket
    rnd = random.Random(2)
    vals = sorted([0.0, 1.0, -1.0] + [rnd.uniform(-1, 1) * 10 ** rnd.randint(-12, 18) for _ in range(3000)])
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.orderBy("v").select(bucket(F.col("v"))).collect()]
    assert got == sorted(got)
