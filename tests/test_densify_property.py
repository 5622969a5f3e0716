"""Season gap filling against a brute-force reference on random inputs."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from fishladder.operators.passage import season_dense

BASE = dt.date(1976, 7, 1)


def brute(daily, limit):
    """Per group: every day from the first day to the limit, zero counts on
    new days, totals carried from the last day with data; rows beyond the
    limit kept as they are."""
    out = []
    groups = {}
    for g, d, n, r, a in daily:
        groups.setdefault(g, []).append((d, n, r, a))
    for g, rows in groups.items():
        rows.sort()
        have = {d: (n, r, a) for d, n, r, a in rows}
        lo = rows[0][0]
        days = set(have)
        if limit >= lo:
            days |= {lo + dt.timedelta(days=i) for i in range((limit - lo).days + 1)}
        last = (None, None)
        for d in sorted(days):
            if d in have:
                n, r, a = have[d]
                last = (r, a)
                out.append((g, d, n, r, a))
            else:
                out.append((g, d, 0, last[0], last[1]))
    return sorted(out)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["DWOR", "KOOS"]), st.integers(0, 40), st.integers(1, 5)),
                min_size=1, max_size=25, unique_by=lambda t: (t[0], t[1])),
       st.integers(-5, 50))
def test_season_dense_matches_brute_force(spark, raw, limit_off):
    raw = sorted(raw)
    daily, totals = [], {}
    for g, off, n in raw:
        totals[g] = totals.get(g, 0) + n
    run = {}
    for g, off, n in raw:
        run[g] = run.get(g, 0) + n
        daily.append((g, BASE + dt.timedelta(days=off), n, run[g], totals[g]))
    limit = BASE + dt.timedelta(days=limit_off)
    df = spark.createDataFrame(
        [(d, 2025, "Chinook", g, n, r, a, "Lower Granite") for g, d, n, r, a in daily],
        "dummy_date date, spawn_year int, species string, hatchery string, daily_total long, "
        "running_total long, annual_total long, dam string")
    lim = spark.createDataFrame([("Chinook", "Lower Granite", limit)], "species string, dam string, max_date date")
    got = sorted((r["hatchery"], r["dummy_date"], r["daily_total"], r["running_total"], r["annual_total"])
                 for r in season_dense(df, lim, "max_date").collect())
    assert got == brute(daily, limit)
