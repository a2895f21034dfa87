"""Positions and neighbours within a key without one task per key.

`Window.partitionBy(key)` sends every row of a key to one task. When one key
may hold a large share of the rows (one chat, one thread), its rows are cut
into buckets by values of the first order column. The cuts are plain numbers,
so a row's bucket depends on the row alone, and everything is joined by
(key, bucket), never by where Spark put a row. Cuts are approximate
quantiles; only balance depends on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 128


def order_cuts(df: DataFrame, column: str, buckets: int = BUCKETS) -> list[float]:
    """Ascending values that cut a numeric or time column into ranges of
    about equal size."""
    if buckets < 2:
        return []
    number = df.select(F.col(column).cast("double").alias("x"))
    return sorted(set(number.stat.approxQuantile("x", [i / buckets for i in range(1, buckets)], 1 / (4 * buckets))))


def bucket_of(value: Column, cuts: list[float]) -> Column:
    """How many cuts are at or below `value` (null: -1, before all others):
    a binary search written as nested conditions, inside generated code."""
    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value < F.lit(cuts[mid]), search(lo, mid)).otherwise(search(mid + 1, hi))
    return F.when(value.isNull(), F.lit(-1)).otherwise(search(0, len(cuts)))


def _bucketed(df: DataFrame, order: list[str], buckets: int) -> DataFrame:
    return df.withColumn("_b", bucket_of(F.col(order[0]).cast("double"), order_cuts(df, order[0], buckets)))


def rank_within(df: DataFrame, key: str, order: list[str], out: str = "rank", buckets: int = BUCKETS) -> DataFrame:
    """Add `out` = 1-based position of each row within `key` by `order`
    (ascending, nulls first), the exact `row_number()`.

    The first column of `order` is a number or a time; the last one is
    unique within the key, so a task that runs again gives the same
    positions. Rows are counted per (key, bucket), summed over the buckets
    before (at most `buckets` rows per key), and numbered within a bucket.
    """
    b = _bucketed(df, order, buckets)
    counts = b.groupBy(key, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col(key).alias("_k"), F.col("_b").alias("_kb"),
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(key, "_b").orderBy(*order)
    numbered = b.withColumn("_i", F.row_number().over(inside))
    j = numbered.join(offsets, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_b") == F.col("_kb")))
    return j.withColumn(out, (F.col("_off") + F.col("_i")).cast("bigint")).drop("_b", "_k", "_kb", "_off", "_i")


def previous_within(df: DataFrame, key: str, order: list[str], value: str, out: str,
                    buckets: int = BUCKETS) -> DataFrame:
    """`lag(value)` over (key, order): within a bucket, and for its first row
    the last value of the key's bucket before it. Same terms as `rank_within`."""
    b = _bucketed(df, order, buckets)
    lasts = b.groupBy(key, "_b").agg(F.max_by(F.struct(value), F.struct(*order)).alias("_last"))
    chain = Window.partitionBy(key).orderBy("_b")
    carried = lasts.select(F.col(key).alias("_k"), F.col("_b").alias("_kb"), F.lag("_last").over(chain).alias("_carry"))
    inside = Window.partitionBy(key, "_b").orderBy(*order)
    local = b.withColumn("_prev", F.lag(F.struct(value)).over(inside))
    j = local.join(carried, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_b") == F.col("_kb")))
    return j.withColumn(out, F.coalesce("_prev", "_carry")[value]).drop("_b", "_k", "_kb", "_carry", "_prev")
