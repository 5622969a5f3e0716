"""A tag holding a third of all detections must not add shuffle volume:
its rows are combined map-side before every exchange."""

from pyspark.sql import functions as F

from fishladder.operators import history as H
from fishladder.sources import driver as Dv

SF = "/root/testdata/sf0.01"


def _walk(node):
    yield node
    name = node.getClass().getSimpleName()
    if "QueryStageExec" in name:
        yield from _walk(node.plan())
        return
    if name == "ReusedExchangeExec":
        yield from _walk(node.child())
        return
    it = node.children().iterator()
    while it.hasNext():
        yield from _walk(it.next())


def shuffled_rows(df) -> int:
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    plan = qe.executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.finalPhysicalPlan()
    total = 0
    for n in _walk(plan):
        if n.getClass().getSimpleName() == "ShuffleExchangeExec":
            m = n.metrics()
            if m.contains("shuffleRecordsWritten"):
                total += m.apply("shuffleRecordsWritten").value()
    return total


def test_hot_tag_adds_no_shuffle_volume(spark):
    plain = Dv.detections(spark, SF)
    skewed = plain.withColumn("pit_id", F.when(F.col("pit_id") % 3 == 0, F.lit(-1)).otherwise(F.col("pit_id")))
    assert skewed.where(F.col("pit_id") == -1).count() * 3 > plain.count() * 0.9
    dams = Dv.dam_key(spark)
    for build in (lambda d: H.wide_first_detections(H.attach_dams(d, dams, "obs_sitecode"), keys=("pit_id", "obs_year")),
                  H.first_per_site_day):
        p, s = shuffled_rows(build(plain)), shuffled_rows(build(skewed))
        assert 0 < s < p, (p, s)


def test_hot_release_event_shuffles_no_marks(spark, tmpdir_path):
    """One release event with a third of all marks: marks meet the tally
    without a shuffle, and beyond the broadcast limit no task gets them all."""
    from fishladder.operators import releases as R
    marks = Dv.marks(spark, SF).withColumn("n", F.xxhash64("pit_id"))
    hot = F.pmod(F.col("n"), F.lit(3)) == 0
    for c, v in (("hatchery", "BUILDING"), ("species", "Chinook"), ("release_sitecode", "DWORNF")):
        marks = marks.withColumn(c, F.when(hot, F.lit(v)).otherwise(F.col(c)))
    marks = marks.withColumn("release_date", F.when(hot, F.lit("2000-04-01").cast("date")).otherwise(F.col("release_date").cast("date")))
    path = f"{tmpdir_path}/marks"
    marks.drop("n").write.parquet(path)
    marks = spark.read.parquet(path)
    assert shuffled_rows(R.release_order(marks)) == 0
    salted = R.release_order(marks, 0)
    assert shuffled_rows(salted) > 0 and salted.count() == marks.count()
    key = lambda df: sorted((r["pit_id"], str(r["release_year"]), r["release_order"]) for r in df.collect())
    assert key(salted) == key(R.release_order(marks))
