"""Ranks over a whole table (SO1) without a window that moves every row to one task.

Rows are sorted by Spark's range partitioning and written to the shared folder with their range and their place in it;
a row's rank is its place after all rows of earlier ranges.  Written rows stay as they are: sampling again, or a lost
executor, cannot move a limit between ranges once ranks are given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditspark.operators.cache import small
from creditspark.operators.models import reliable

_PLACE_BITS = 33  # monotonically_increasing_id keeps the row's place in these


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with its 1-based place (long) in ``order``.

    ``order`` should name a tiebreak: rows that tie in all of it share consecutive ranks in no fixed order.
    The offsets are one row per range, that is at most one per shuffle partition.
    """
    place = F.monotonically_increasing_id()
    rows = reliable(df.orderBy(*order).withColumn("__id", place))
    rows = rows.withColumn("__range", F.shiftright("__id", _PLACE_BITS))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("__range").agg(F.count(F.lit(1)).alias("__n")).select(
        "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    rank = F.col("__before") + F.col("__id") - F.shiftleft("__range", _PLACE_BITS) + 1
    return rows.join(small(offsets), "__range").select(*df.columns, rank.alias(name))
