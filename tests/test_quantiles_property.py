"""Exact quantiles, with and without a bucket width, against numpy on random, duplicate-heavy data."""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from fishladder.operators.quantiles import grouped_quantiles

PROBS = {"q10": 0.1, "q50": 0.5, "q75": 0.75}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(-3, 6)), min_size=1, max_size=60),
       st.integers(1, 6))
def test_quantile_paths_match_numpy(spark, data, parts):
    df = spark.createDataFrame(data, "g string, v long").repartition(parts)
    groups = {}
    for g, v in data:
        groups.setdefault(g, []).append(v)
    for width in (None, 1):
        got = {r["g"]: r for r in grouped_quantiles(df, ["g"], "v", PROBS, width=width).collect()}
        assert set(got) == set(groups), width
        for g, vals in groups.items():
            for name, p in PROBS.items():
                assert math.isclose(got[g][name], float(np.quantile(vals, p)), abs_tol=1e-9), (width, g, name)
