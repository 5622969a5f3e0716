"""Mixing sources to target weights by hash-threshold histograms, SQL functions only.

Every source has a weight and shares the sum of all sizes by it, but no source
gives more than ``max_repeat`` times its own size; what is over is shared again
by weight among the others. The fixed point of that sharing is one level per
unit of weight: sorted by size per weight, the sources below the level give
their maximum, the others weight x level, found by running sums over the
sources.

A source then gives all its documents ``full`` times (the whole part of target
/ size) and once more those whose hash lies below its threshold. The threshold
is found without sorting documents: sizes are summed by source and the first
12 bits of the hash, the bucket in which the wanted sum is passed is the
boundary, and only documents of that bucket are summed again by the next 12
bits, then by 12 more. After 36 bits the boundary holds a document or two; it
is taken if that brings the sum nearer. The hash is taken from id and text, so
reruns agree and a smaller budget takes a subset of a larger one.

Defined cases: null text has size 0; null sources form one source, the last;
rows equal in id and text share their hash and go together; sources of size 0
have target 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fishladder.llm.common import documents, packed, small, work_dir, write_table
from fishladder.operators.verbs import join_null_safe

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
LEVELS, DIGITS = 3, 3          # three histograms of three hexadecimal digits (12 bits) each


def word_count(text):
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def doc_hash(doc_id, text):
    return F.substring(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"),
                                      F.coalesce(text, F.lit(""))).cast("binary")), 1, LEVELS * DIGITS)


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target, full, need) from (source, source_size).

    Runs on one row per source. All sums are exact integers; a target is one
    division.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    t = sizes.withColumn("weight", F.element_at(cycle, (F.pmod(rank, F.lit(len(weights))) + 1).cast("int")))
    t = t.withColumn("cap", F.col("source_size") * max_repeat)
    d = lambda c: c.cast("decimal(38,0)")
    all_rows = Window.partitionBy()
    below = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()) \
                  .rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumns({
        "total": F.sum("source_size").over(all_rows), "weights": F.sum("weight").over(all_rows),
        "cap_below": F.coalesce(F.sum("cap").over(below), F.lit(0)),
        "weight_below": F.coalesce(F.sum("weight").over(below), F.lit(0))})
    # level left when all sources below this one give their maximum
    t = t.withColumns({"rest": F.col("total") - F.col("cap_below"), "rest_weights": F.col("weights") - F.col("weight_below")})
    t = t.withColumn("free", d(F.col("cap")) * d(F.col("rest_weights")) >= d(F.col("weight")) * d(F.col("rest")))
    # the sources from the first free one on share what is left; it has the largest rest_weights among the free
    first = F.max(F.when(F.col("free"), F.struct("rest_weights", "rest"))).over(all_rows)
    t = t.withColumn("level", first)
    share = d(F.col("weight")) * d(F.col("level.rest"))
    target = F.when(F.col("rest_weights") > F.col("level.rest_weights"), F.col("cap").cast("double")) \
              .when(F.col("level").isNull(), F.col("cap").cast("double")) \
              .otherwise(share.cast("double") / F.col("level.rest_weights").cast("double"))
    t = t.withColumn("target", F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(target))
    full = F.when(F.col("source_size") == 0, F.lit(0)).otherwise(F.floor(F.col("target") / F.col("source_size")))
    t = t.withColumn("full", full.cast("long"))
    return t.select("source", "source_size", "target", "full",
                    (F.col("target") - F.col("full") * F.col("source_size")).alias("need"))


def thresholds(facts: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, edge): documents with hash < edge are taken once more."""
    spark = facts.sparkSession
    bounds = targets.select("source", "need", F.lit("").alias("edge"), F.lit(0).cast("long").alias("taken"))
    for level in range(LEVELS):
        inside = facts if level == 0 else join_null_safe(
            facts, small(bounds.select("source", "edge")), ["source"]) \
            .where(F.substring("hash", 1, level * DIGITS) == F.col("edge")).drop("edge")
        hist = inside.groupBy("source", F.substring("hash", 1, (level + 1) * DIGITS).alias("bucket")) \
                     .agg(F.sum("size").alias("in_bucket"))
        upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        hist = join_null_safe(hist.withColumn("upto", F.sum("in_bucket").over(upto)), small(bounds), ["source"])
        # the bucket in which the wanted sum is passed; the last one is passed at the latest when all is taken
        passed = F.col("taken") + F.col("upto") > F.col("need")
        pick = hist.where(passed).groupBy("source", "need").agg(
            F.min(F.struct("bucket", (F.col("taken") + F.col("upto") - F.col("in_bucket")).alias("before"), "in_bucket")).alias("p"))
        bounds = write_table(pick.select("source", "need", F.col("p.bucket").alias("edge"), F.col("p.before").alias("taken"),
                                         F.col("p.in_bucket").alias("in_bucket")), work_dir(spark, f"mix-level-{level}"))
        last, bounds = bounds, bounds.drop("in_bucket")
    # the boundary bucket itself is taken if the sum then ends nearer to the wanted one
    nearer = F.col("taken") + F.col("in_bucket") - F.col("need") <= F.col("need") - F.col("taken")
    return last.select("source", F.when(nearer, F.concat("edge", F.lit("~"))).otherwise(F.col("edge")).alias("edge"))


def mix_facts(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return df.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                     word_count(text).alias("size"), doc_hash(F.col(id_col), text).alias("hash"))


def mix_plan(facts: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target, full, edge), one row per source; ``facts`` is a written table."""
    spark = facts.sparkSession
    sizes = facts.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = write_table(source_targets(sizes, weights, max_repeat), work_dir(spark, "mix-targets"))
    plan = join_null_safe(targets.drop("need"), thresholds(facts, targets), ["source"], "left")
    return write_table(plan, work_dir(spark, "mix-plan"))


def copies(hash_):
    """How often a row with this hash is taken under its source's plan."""
    return F.col("full") + F.when(F.coalesce(hash_ < F.col("edge"), F.lit(False)), 1).otherwise(0)


def mix(df: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, copies and taken for every row."""
    facts = write_table(mix_facts(df, id_col, text_col, source_col), work_dir(df.sparkSession, "mix-facts"))
    out = join_null_safe(facts, small(mix_plan(facts, weights, max_repeat)), ["source"], "left")
    return out.withColumn("copies", copies(F.col("hash"))) \
              .select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_rows(df: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, id_col: str = "doc_id",
               text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``df``, all columns, each as often as the mix takes it."""
    facts = write_table(mix_facts(df, id_col, text_col, source_col), work_dir(df.sparkSession, "mix-facts"))
    plan = mix_plan(facts, weights, max_repeat).withColumnRenamed("source", "of")
    rows = df.select(packed(df), F.col(source_col).cast("string").alias("src"),
                     doc_hash(F.col(id_col), F.col(text_col).cast("string")).alias("hash"))
    rows = rows.join(small(plan), F.col("src").eqNullSafe(F.col("of")))
    return rows.select("_row", F.explode(F.array_repeat(F.lit(0), copies(F.col("hash")).cast("int")))).select("_row.*")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


OP7_SQL = r"""
WITH RECURSIVE f AS (
  SELECT doc_id, source, CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size,
         left(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 9) AS hash
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM f GROUP BY source),
k AS (SELECT source, source_size, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight FROM s),
-- sharing again and again: each round caps what is above 3 times its size
r AS (SELECT 0 AS round, source, source_size, weight, false AS capped FROM k
      UNION ALL
      SELECT round + 1, source, source_size, weight,
             capped OR (3 * source_size) * free_weight < weight * rest
      FROM (SELECT *, sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () AS free_weight,
                   sum(source_size) OVER () - sum(CASE WHEN capped THEN 3 * source_size ELSE 0 END) OVER () AS rest FROM r)
      WHERE round < (SELECT count(*) FROM k)),
e AS (SELECT source, source_size, weight, capped, sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () AS free_weight,
             sum(source_size) OVER () - sum(CASE WHEN capped THEN 3 * source_size ELSE 0 END) OVER () AS rest
      FROM r WHERE round = (SELECT max(round) FROM r)),
t AS (SELECT source, source_size, CASE WHEN source_size = 0 THEN 0.0::DOUBLE WHEN capped THEN CAST(3 * source_size AS DOUBLE)
             ELSE CAST(weight * rest AS DOUBLE) / CAST(free_weight AS DOUBLE) END AS target FROM e),
n AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(target / source_size) AS BIGINT) END AS full_n FROM t),
g AS (SELECT source, hash, sum(size) AS in_bucket FROM f GROUP BY source, hash),
c AS (SELECT g.source, g.hash, g.in_bucket, sum(g.in_bucket) OVER (PARTITION BY g.source ORDER BY g.hash) AS upto,
             n.target - n.full_n * n.source_size AS need
      FROM g JOIN n ON g.source IS NOT DISTINCT FROM n.source),
x AS (SELECT source, hash, upto <= need OR (upto - in_bucket <= need AND upto - need <= need - (upto - in_bucket)
             AND in_bucket > 0 AND upto > need) AS more FROM c)
SELECT f.doc_id, f.size, n.source_size, n.target, CAST(f.size * (n.full_n + CASE WHEN x.more THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM f JOIN n ON f.source IS NOT DISTINCT FROM n.source JOIN x ON f.source IS NOT DISTINCT FROM x.source AND f.hash = x.hash
"""
