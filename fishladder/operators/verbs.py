"""Core verbs shared by every pipeline.

Design rules (they matter at 100 TB):
* "first/last row per key" is an aggregation (``min``/``max`` of a struct),
  never a window: Spark combines it map-side, so a tag with a third of all
  detections is collapsed inside each map task before anything shuffles.
* Running totals and gap filling only ever run on already aggregated daily
  tables (groups x season days), never on raw detections.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _pick(df: DataFrame, keys, order, cols, agg) -> DataFrame:
    keys, order = _names(keys), _names(order)
    if cols is None:
        cols = [c for c in df.columns if c not in keys and c not in order]
    cols = [c for c in _names(cols) if c not in order]
    # A group whose ordering value is all NULL yields no row.
    cond = reduce(lambda a, b: a & b, [F.col(o).isNotNull() for o in order])
    if not cols and len(order) == 1:
        # nothing to carry: a plain min/max keeps the (hash) partial aggregation
        return df.where(cond).groupBy(*keys).agg(agg(order[0]).alias(order[0]))
    packed = F.struct(*[F.col(c) for c in order + cols])
    out = df.where(cond).groupBy(*keys).agg(agg(packed).alias("_pick"))
    return out.select(*keys, *[F.col("_pick." + c).alias(c) for c in order + cols])


def first_by(df: DataFrame, keys, order, cols=None) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order`` values.

    Ties are broken by the remaining columns in ``cols`` order, so the choice
    does not depend on input order or partitioning.
    """
    return _pick(df, keys, order, cols, F.min)


def last_by(df: DataFrame, keys, order, cols=None) -> DataFrame:
    """One row per ``keys``: the row with the largest ``order`` values."""
    return _pick(df, keys, order, cols, F.max)


def running_totals(df: DataFrame, partition, order, value: str,
                   running: str = "running_total", total: str = "annual_total",
                   fill_null: bool = False) -> DataFrame:
    """Row-by-row cumulative sum and partition total.

    ``order`` must make rows unique inside a partition (ROWS frame, N7).
    Items of ``order`` may be Columns (e.g. ``F.col('d').asc_nulls_last()``).
    """
    partition = _names(partition)
    order = [F.col(o) if isinstance(o, str) else o for o in _names(order)] \
        if not isinstance(order, Column) else [order]
    if fill_null:
        df = df.withColumn(value, F.coalesce(F.col(value), F.lit(0).cast(df.schema[value].dataType)))
    w = Window.partitionBy(*partition).orderBy(*order)
    return (df.withColumn(running, F.sum(value).over(
                w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
              .withColumn(total, F.sum(value).over(Window.partitionBy(*partition))))


def carry_forward(df: DataFrame, partition, order, cols) -> DataFrame:
    """Fill NULLs with the last non-NULL value above (fill direction "down")."""
    w = (Window.partitionBy(*_names(partition)).orderBy(*_names(order))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for c in _names(cols):
        df = df.withColumn(c, F.last(c, ignorenulls=True).over(w))
    return df


def densify_dates(df: DataFrame, keys, date_col: str, upper: str) -> DataFrame:
    """Add the missing days of every group from its first day to ``upper``.

    ``upper`` is a column of ``df`` (the group's season end; its max per group
    is used). Every row is followed by the days up to the next row's day, or
    to the end for the last one, so no join is needed and filters on the keys
    reach the input. Rows beyond the end or without a day are kept (N12); a
    group whose end lies before its first day gets no new rows (N13). New
    rows have the keys and the day only.
    """
    keys = _names(keys)
    day, group = F.col(date_col), Window.partitionBy(*_names(keys))
    d = df.withColumns({"_next": F.lead(date_col).over(group.orderBy(F.col(date_col).asc_nulls_first())),
                        "_end": F.max(upper).over(group)})
    last = F.least(F.date_sub("_next", 1), F.col("_end"))
    fill = F.when(day.isNotNull() & F.col("_end").isNotNull() & (last > day),
                  F.sequence(day, last, F.expr("INTERVAL 1 DAY"))).otherwise(F.array(day))
    d = d.select(*df.columns, F.posexplode(fill).alias("_pos", "_day"))
    rest = [c for c in df.columns if c not in keys + [date_col]]
    return d.select(*keys, F.col("_day").alias(date_col), *[F.when(F.col("_pos") == 0, F.col(c)).alias(c) for c in rest])


def union_all(*dfs: DataFrame) -> DataFrame:
    """Row bind by column name; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def join_null_safe(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join on nullable keys, NULL matching NULL (N5); the right side's key
    columns are renamed in one projection and dropped after the join."""
    keys = _names(keys)
    r = right.select(*[F.col(c).alias("_r_" + c) if c in keys else F.col(c) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col("_r_" + k)) for k in keys])
    j = left.join(r, cond, how)
    return j.select(*[c for c in j.columns if not (c.startswith("_r_") and c[3:] in keys)])


def filter_not_in(col: str, values) -> Column:
    """``!x %in% values`` keeping NULL x."""
    return F.col(col).isNull() | ~F.col(col).isin(list(values))
