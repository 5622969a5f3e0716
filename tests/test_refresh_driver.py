"""The refresh job and the registered queries compute the same tables."""

from fishladder.plans.queries import REGISTRY, naive_timestamps
from fishladder.plans.refresh import build_catalog, inputs_from_driver

SF = "/root/testdata/sf0.001"

SAME = {"marks": "release_group", "juv_history": "juvenile_history", "emigration_history": "emigration_summary",
        "travel": "upstream_excluded", "emigration_all": "emigration_all", "adult_complete": "adult_complete",
        "adult_inseason": "adult_inseason", "window_daily": "window_all", "water": "gauge_year"}


def _rows(df, cols):
    return sorted(tuple(str(r[c]) for c in cols) for r in df.collect())


def test_catalog_equals_registered_queries(spark, tmpdir_path):
    paths = build_catalog(spark, inputs_from_driver(spark, SF), f"{tmpdir_path}/cat")
    assert set(SAME) <= set(paths)
    for table, query in SAME.items():
        q = REGISTRY[query](spark, SF)
        t = naive_timestamps(spark.read.parquet(paths[table]))
        cols = sorted(q.columns)
        assert sorted(t.columns) == cols, table
        assert _rows(t, cols) == _rows(q, cols), table


def test_app_tables_from_catalog(spark, tmpdir_path):
    import datetime as dt

    from fishladder.plans import dashboard as B
    from fishladder.sources import driver as D
    paths = build_catalog(spark, inputs_from_driver(spark, SF), f"{tmpdir_path}/cat")
    app = B.load_app_tables(spark, paths, D.AS_OF, 1999)
    assert set(app) >= {"water", "emigration", "adults", "window", "emigration_summaries"}
    # a panel on the loaded tables equals the registered query over the driver tables
    sel = B.adults(app["adults"], "Lower Granite", "Steelhead", (1999, 2002))
    assert _rows(sel, sorted(sel.columns)) == _rows(REGISTRY["b05"](spark, SF), sorted(sel.columns))
    assert app["emigration_max"].count() == app["emigration"].select("species").distinct().count()
    assert isinstance(D.AS_OF, dt.date)


def test_operators_accept_naive_timestamps(spark):
    """Tables written from the registry carry TIMESTAMP_NTZ; the operators
    must give the same answers on them."""
    from fishladder.operators.summaries import emigration_summary
    hist = REGISTRY["juvenile_history"](spark, SF)          # NTZ at the registry boundary
    assert "timestamp_ntz" in dict((f.name, f.dataType.simpleString()) for f in hist.schema.fields)["LGR"]
    got = emigration_summary(hist)
    cols = sorted(got.columns)
    assert _rows(got, cols) == _rows(REGISTRY["emigration_summary"](spark, SF), cols)
