"""Exact type-7 quantiles per group, by one distributed algorithm at every size.

A quantile needs one or two order statistics, so nothing is sorted as a whole.  Doubles become 64-bit keys of the same order
(-0.0 is 0.0; a NaN comes last, as in Spark's own order), and keys are cut by digits:

1. Each group's keys are counted by their first DIGIT bits below the highest bit in which its least and greatest key differ (one
   aggregate, at most 2 ** DIGIT rows per group after map-side combining), and the running counts tell in which
   bucket each wanted rank lies.
2. Only rows of such buckets go on (a join on group and bucket); a bucket that still holds more than
   ``rows_per_bucket`` values is cut again in the same way, by its next digit: six times at most, whatever the values
   (infinities, NaN and any spread included).
3. What is left of each bucket, at most ``rows_per_bucket`` values, is sorted and yields its ranks; a bucket of one
   single value needs no sorting, however many rows it has.

No task holds more than ``rows_per_bucket`` values, no rows are joined to ranks by a range, and no
distinct count picks another method.  Output: one row per group with ``q`` = quantiles in ``probs`` order.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from creditspark.operators.cache import persist, small

ROWS_PER_BUCKET = 100_000
DIGIT = 11
_REST = np.int64(0x7FFFFFFFFFFFFFFF)


@F.arrow_udf(LongType())
def order_key(x: pa.Array) -> pa.Array:
    """Doubles as integers of the same order: the bits, those of negative numbers below the sign turned round."""
    v = x.to_numpy(zero_copy_only=False) + 0.0
    bits = np.where(np.isnan(v), np.nan, v).view(np.int64)
    return pa.array(np.where(bits < 0, bits ^ _REST, bits))


@F.arrow_udf(DoubleType())
def from_key(k: pa.Array) -> pa.Array:
    bits = k.to_numpy(zero_copy_only=False)
    return pa.array(np.where(bits < 0, bits ^ _REST, bits).view(np.float64))


def column_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list[float | None]]:
    """Type-7 quantiles per column (NULLs skipped) -> {column: [q per prob]} (small, for models)."""
    if not cols:
        return {}
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "variable", "value")
    vals = {r["variable"]: r["q"] for r in grouped_quantiles(long, ["variable"], "value", probs).collect()}
    return {c: list(vals.get(c) or [None] * len(probs)) for c in cols}


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL matches NULL (a NULL group is a group)."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [left[c].eqNullSafe(r[f"__r_{c}"]) for c in keys])
    return left.join(r, cond, how).drop(*[f"__r_{c}" for c in keys])


def grouped_quantiles(long: DataFrame, group_cols: list[str], value: str, probs: list[float],
                      rows_per_bucket: int | None = None) -> DataFrame:
    g, rows_per_bucket = list(group_cols), rows_per_bucket or ROWS_PER_BUCKET
    vals = persist(long.filter(F.col(value).isNotNull()).select(*g, order_key(F.col(value).cast("double")).alias("__v")))
    groups = persist(vals.groupBy(*g).agg(F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi")))
    last = (F.col("__n") - 1).cast("double")
    ends = [end(last * F.lit(float(p))).cast("long") for p in probs for end in (F.floor, F.ceil)]
    # open parts: a range of values, how many rows of the group lie below it, and the ranks wanted in it
    parts = groups.select("*", F.array_distinct(F.array(*ends)).alias("__ranks"), F.lit(0).cast("long").alias("__below"))
    rows, keys, found, turn = vals, list(g), None, 0
    while True:
        parts = persist(parts)
        single = parts.filter(F.col("__lo") == F.col("__hi")).select(*g, F.explode("__ranks").alias("__r"), F.col("__lo").alias("__v"))
        found = single if found is None else found.unionByName(single)
        parts = parts.filter(F.col("__lo") < F.col("__hi"))
        fits = F.col("__n") <= rows_per_bucket
        held = _join_null_safe(rows, small(parts.filter(fits).drop("__n")), keys)
        sorted_ = held.groupBy(*keys, "__below", "__ranks").agg(F.sort_array(F.collect_list("__v")).alias("__s"))
        found = found.unionByName(sorted_.select(*g, F.explode("__ranks").alias("__r"), "__below", "__s")
                                  .select(*g, "__r", F.get("__s", (F.col("__r") - F.col("__below")).cast("int")).alias("__v")))
        parts = persist(parts.filter(~fits))
        if parts.isEmpty():
            break
        step = f"__b{turn}"
        # above the bits that are shifted out and the digit, all keys of the part agree
        shift = F.greatest(F.length(F.bin(F.col("__lo").bitwiseXOR(F.col("__hi")))) - DIGIT, F.lit(0)).alias("__shift")
        rows = _join_null_safe(rows, small(parts.select(*keys, shift)), keys).withColumn(step, F.call_function("shiftright", "__v", "__shift")).drop("__shift")
        counts = rows.groupBy(*keys, step).agg(F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
        before = Window.partitionBy(*keys).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        parent = small(parts.select(*keys, "__below", F.col("__ranks").alias("__all")))
        below = F.col("__below") + F.col("__off")
        parts = _join_null_safe(counts, parent, keys).withColumn("__below", below).withColumn(
            "__ranks", F.filter("__all", lambda r: (r >= F.col("__below")) & (r < F.col("__below") + F.col("__n"))))
        parts = parts.filter(F.size("__ranks") > 0).select(*keys, step, "__n", "__lo", "__hi", "__ranks", "__below")
        keys, turn = [*keys, step], turn + 1
    found = found.select(*g, "__r", from_key("__v").alias("__v"))
    stats = found.groupBy(*g).agg(F.map_from_entries(F.collect_set(F.struct("__r", "__v"))).alias("__m"))
    out = _join_null_safe(groups.select(*g, "__n"), stats, g)

    def quantile(p):
        pos = last * p
        lo, hi = F.floor(pos).cast("long"), F.ceil(pos).cast("long")
        x, y = F.try_element_at("__m", lo), F.try_element_at("__m", hi)
        # interpolation as in Spark's percentile: (hi - pos) * x_lo + (pos - lo) * x_hi
        return F.when((hi == lo) | (x == y), x).otherwise((hi - pos) * x + (pos - lo) * y)

    # one expression for all probabilities: code for a hundred would not compile
    return out.select(*g, F.transform(F.array(*[F.lit(float(p)) for p in probs]), quantile).alias("q"))
