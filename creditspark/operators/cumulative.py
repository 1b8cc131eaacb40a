"""Distributed running totals over a global order.

``Window.orderBy(x)`` without ``partitionBy`` moves every row to one task.
Instead, rows are cut into ``n_buckets`` contiguous ranges of the order
column (Spark's sampled range partitioning, so each range holds about the
same number of rows; a range's least value is its limit, which is kept, so
that any later reading of the plan cuts alike), per-range totals are prefix-summed on the tiny range
table, and each range computes its own running sum plus its offset.
The offset table has one row per million and is broadcast if it is counted to be small.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditspark.operators.cache import persist, small

DEFAULT_BUCKETS = None          # None: sized from the input
ROWS_PER_BUCKET = 1_000_000     # target rows per running-sum task


def _limits(df: DataFrame, keys: list[str], order_col: str, n: int) -> DataFrame:
    """(keys..., __limit): the least value of each group in each of ``n`` ranges of (keys, order_col)."""
    x = F.col(order_col).cast("double").alias("__limit")
    ranged = df.select(*keys, x).repartitionByRange(n, *keys, "__limit")
    return ranged.groupBy(*keys, F.spark_partition_id().alias("__p")).agg(F.min("__limit").alias("__limit")).drop("__p")


def _bucket_splits(df: DataFrame, order_col: str, n_buckets: int) -> list[float]:
    """Limits between buckets: one number per bucket, that is per ROWS_PER_BUCKET rows."""
    if n_buckets <= 1:
        return [-math.inf, math.inf]
    cuts = {r["__limit"] for r in _limits(df, [], order_col, n_buckets).collect()}
    return [-math.inf, *sorted(c for c in cuts if c is not None and math.isfinite(c)), math.inf]


def _count_at_most(limits: Column, x: Column, n: int) -> Column:
    """How many of the sorted ``limits`` (at most ``n``) are at most ``x``: a binary search, JVM-side."""
    steps = F.array(*[F.lit(1 << b) for b in range(n.bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(limits, at + step - 1) <= x, at + step).otherwise(at))


def partitioned_running_totals(df: DataFrame, partition_cols: list[str], order_col: str, value_cols: list[str],
                               descending: bool = True, rows_per_bucket: int = ROWS_PER_BUCKET,
                               prefix: str = "cum_") -> DataFrame:
    """``running_totals`` restarted in every group of ``partition_cols``.

    The rows are cut into ranges of (group, value) of about ``rows_per_bucket`` rows, so one large group
    is still spread over many tasks.  ``df`` holds one row per (group, order value).
    """
    from creditspark.operators.quantiles import _join_null_safe
    g = list(partition_cols)
    df = persist(df)
    n_b = max(1, -(-df.count() // rows_per_bucket))
    if n_b > 1:
        cuts = _limits(df, g, order_col, n_b).groupBy(*g).agg(F.array_sort(F.collect_list("__limit")).alias("__cuts"))
        bucketed = _join_null_safe(df, cuts, g).withColumn(
            "__bkt", _count_at_most(F.col("__cuts"), F.col(order_col).cast("double"), n_b)).drop("__cuts")
    else:
        bucketed = df.withColumn("__bkt", F.lit(0))
    per_bucket = bucketed.groupBy(*g, "__bkt").agg(*[F.sum(c).alias(f"__b_{c}") for c in value_cols])
    bucket_order = F.col("__bkt").desc() if descending else F.col("__bkt").asc()
    w_prev = Window.partitionBy(*g).orderBy(bucket_order).rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*g)
    offsets = per_bucket.select(
        *g, "__bkt",
        *[F.coalesce(F.sum(f"__b_{c}").over(w_prev), F.lit(0)).alias(f"__off_{c}") for c in value_cols],
        *[F.sum(f"__b_{c}").over(w_all).alias(f"total_{c}") for c in value_cols])
    joined = _join_null_safe(bucketed, offsets, [*g, "__bkt"])
    row_order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    w_in = Window.partitionBy(*g, "__bkt").orderBy(row_order).rowsBetween(Window.unboundedPreceding, 0)
    out = joined
    for c in value_cols:
        out = out.withColumn(f"{prefix}{c}", F.col(f"__off_{c}") + F.sum(c).over(w_in))
        out = out.withColumn(f"prev_{c}", F.col(f"{prefix}{c}") - F.col(c))
    return out.drop("__bkt", *[f"__off_{c}" for c in value_cols])


def running_totals(df: DataFrame, order_col: str, value_cols: list[str], descending: bool = True,
                   n_buckets: int | None = DEFAULT_BUCKETS, prefix: str = "cum_") -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum) and ``prev_<c>`` (exclusive) per value column,
    plus ``total_<c>`` (grand total).

    ``df`` must hold one row per distinct ``order_col`` value (e.g. the output
    of ``groupBy(order_col)``), so the running order has no ties.
    """
    df = persist(df)
    if n_buckets is None:
        n_buckets = max(1, -(-df.count() // ROWS_PER_BUCKET))
    splits = _bucket_splits(df, order_col, n_buckets)
    row_order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    if len(splits) < 3:
        # one bucket (at most ROWS_PER_BUCKET rows when sized automatically): offsets are 0,
        # totals are a window over the same bucket, so no join is needed
        one = df.withColumn("__bkt", F.lit(0))
        w_run = Window.partitionBy("__bkt").orderBy(row_order).rowsBetween(Window.unboundedPreceding, 0)
        w_tot = Window.partitionBy("__bkt")
        for c in value_cols:
            one = (one.withColumn(f"{prefix}{c}", F.sum(c).over(w_run))
                      .withColumn(f"prev_{c}", F.col(f"{prefix}{c}") - F.col(c))
                      .withColumn(f"total_{c}", F.sum(c).over(w_tot)))
        return one.drop("__bkt")
    bucketed = Bucketizer(splits=splits, inputCol="__ord", outputCol="__bkt", handleInvalid="keep") \
        .transform(df.withColumn("__ord", F.col(order_col).cast("double")))
    bucketed = bucketed.withColumn("__bkt", F.col("__bkt").cast("int")).drop("__ord")

    per_bucket = bucketed.groupBy("__bkt").agg(*[F.sum(c).alias(f"__b_{c}") for c in value_cols])
    bucket_order = F.col("__bkt").desc() if descending else F.col("__bkt").asc()
    # the bucket table has <= n_buckets rows: a global window over it is cheap
    w_prev = Window.orderBy(bucket_order).rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(F.lit(1))
    offsets = per_bucket.select(
        "__bkt",
        *[F.coalesce(F.sum(f"__b_{c}").over(w_prev), F.lit(0)).alias(f"__off_{c}") for c in value_cols],
        *[F.sum(f"__b_{c}").over(w_all).alias(f"total_{c}") for c in value_cols],
    )
    joined = bucketed.join(small(offsets), "__bkt", "inner")
    w_in = Window.partitionBy("__bkt").orderBy(row_order).rowsBetween(Window.unboundedPreceding, 0)
    out = joined
    for c in value_cols:
        out = out.withColumn(f"{prefix}{c}", F.col(f"__off_{c}") + F.sum(c).over(w_in))
        out = out.withColumn(f"prev_{c}", F.col(f"{prefix}{c}") - F.col(c))
    return out.drop("__bkt", *[f"__off_{c}" for c in value_cols])
