"""Persistence at branch points of multi-pass operators.

Operators that scan their input more than once persist the narrow projection they need,
MEMORY_AND_DISK so it spills instead of failing.  Lost blocks are recomputed from lineage, so this
survives executor loss.

Every block has an owner: what an operator persists and cannot release itself (its result still
reads it) is released at the end of the enclosing ``scope``; a registered query that starts
releases what earlier queries left.  A plan that several callers persist stays until the last
of them releases it.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: semantic hash of a plan -> the frames that hold it
_held: dict[int, list[DataFrame]] = {}
_order: list[DataFrame] = []


def persist(df: DataFrame) -> DataFrame:
    """``df``, persisted for the caller; to be released by it or by the scope."""
    held = _held.setdefault(df.semanticHash(), [])
    if not held:
        df.persist(StorageLevel.MEMORY_AND_DISK)
    held.append(df)
    _order.append(df)
    return df


def release(df: DataFrame) -> None:
    """Give back one ``persist``; the blocks go with the last one."""
    held = _held.get(df.semanticHash(), [])
    if held:
        held.pop()
        for i in range(len(_order) - 1, -1, -1):
            if _order[i] is df:
                del _order[i]
                break
        if not held:
            del _held[df.semanticHash()]
            df.unpersist(blocking=False)


@contextmanager
def scope():
    """Releases at its end whatever was persisted inside."""
    mark = len(_order)
    try:
        yield
    finally:
        for df in _order[mark:][::-1]:
            release(df)


def release_all() -> None:
    for df in _order[::-1]:
        release(df)


def clear(spark) -> None:
    """Drop every persisted intermediate of this session (call after a flow's results are written)."""
    _held.clear()
    _order.clear()
    spark.catalog.clearCache()


def row_bytes(df: DataFrame) -> Column:
    """About what a row takes: 8 bytes a column, the bytes of strings and binaries, and nested values as JSON."""
    size = F.lit(16 + 8 * len(df.columns)).cast("long")
    for f in df.schema.fields:
        col = F.col("`" + f.name.replace("`", "``") + "`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(col), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(col.alias("v")))), F.lit(0))
    return size


def small(df: DataFrame, most: int = 200_000, most_bytes: int = 256 << 20) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to have at most ``most`` rows of ``most_bytes`` in all; else as it
    is, for the planner to join by a shuffle."""
    n, size = df.select(row_bytes(df).alias("b")).limit(most + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum("b"), F.lit(0))).first()
    return F.broadcast(df) if n <= most and size <= most_bytes else df
