"""Data-quality operators (DQ1-DQ10).

Every operator is a single aggregation or a join against an aggregated key
set.  None puts all rows of one key into one task: duplicate detection
collapses identical rows first (map-side combine) and finds each key's
first occurrence with a ``min(struct)`` aggregate instead of a per-key
window, so a key holding a third of the table is still split across tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """DQ1: (n_rows, n_distinct_keys); a NULL key counts as one value, like R ``duplicated``."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.agg(F.sum("__n").cast("long").alias("n_rows"),
                       F.count(F.lit(1)).alias("n_distinct_keys"))


def duplicate_occurrences(df: DataFrame, keys: list[str], order_cols: list[str] | None = None) -> DataFrame:
    """DQ2: the 2nd and later occurrences of every key (first = smallest row in ``order_cols`` then
    the remaining columns).  Identical rows are emitted once per extra copy.
    """
    cols = df.columns
    order_cols = list(order_cols or [])
    rest = [c for c in cols if c not in keys and c not in order_cols]
    ordering = order_cols + rest
    copies = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__copies"))
    first = (df.groupBy(*keys)
               .agg(F.min(F.struct(*ordering)).alias("__first"), F.count(F.lit(1)).alias("__n"))
               .filter(F.col("__n") > 1))
    first = first.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__first")
    j = copies.join(first, reduce(lambda a, b: a & b, [copies[k].eqNullSafe(first[f"__k_{k}"]) for k in keys]))
    is_first = F.struct(*[F.col(c) for c in ordering]).eqNullSafe(F.col("__first"))
    extra = F.col("__copies") - F.when(is_first, 1).otherwise(0)
    out = j.withColumn("__extra", extra).filter(F.col("__extra") > 0)
    out = out.withColumn("__k", F.explode(F.sequence(F.lit(1), F.col("__extra").cast("int"))))
    return out.select(*cols)


def ambiguous_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys occurring more than once (partial aggregation before the shuffle)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select(*keys)


def drop_ambiguous_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """DQ3/JN2: drop *all* rows of keys that occur more than once (left anti join; NULL equals NULL)."""
    bad = ambiguous_keys(df, keys).select(*[F.col(k).alias(f"__k_{k}") for k in keys])
    return df.join(bad, reduce(lambda a, b: a & b, [df[k].eqNullSafe(bad[f"__k_{k}"]) for k in keys]), "left_anti")


def null_cells(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """DQ4: total NULL cells, one aggregate pass."""
    cols = cols or df.columns
    total = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("long") for c in cols])
    return df.agg(F.coalesce(F.sum(total), F.lit(0)).cast("long").alias("n_null_cells"))


def null_by_column(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """DQ5: (column_name, n_null) from one aggregate pass, then unpivoted."""
    cols = cols or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "n_null")


def target_null_rate(df: DataFrame, label: str) -> DataFrame:
    """DQ6: (n_rows, n_null, null_rate)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(F.col(label).isNull()).cast("long").alias("n_null")) \
        .withColumn("null_rate", F.col("n_null").cast("double") / F.col("n_rows").cast("double"))


def with_population(df: DataFrame, label: str, name: str = "population") -> DataFrame:
    """DQ7: 'labelled' / 'unlabelled' column instead of two materialised copies."""
    return df.withColumn(name, F.when(F.col(label).isNull(), F.lit("unlabelled")).otherwise(F.lit("labelled")))


def full_row_dups(df: DataFrame) -> DataFrame:
    """DQ8: (n_rows, n_distinct_rows, n_full_dups) from one grouped pass."""
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__c"))
    return per_row.agg(F.sum("__c").cast("long").alias("n_rows"),
                       F.count(F.lit(1)).alias("n_distinct_rows"),
                       F.sum(F.col("__c") - 1).cast("long").alias("n_full_dups"))


def key_setdiff(a: DataFrame, b: DataFrame, key_a: str, key_b: str, out: str = "key") -> DataFrame:
    """DQ9: keys only in a ('a_not_b') and only in b ('b_not_a'), EXCEPT DISTINCT both ways."""
    ka = a.select(F.col(key_a).alias(out))
    kb = b.select(F.col(key_b).alias(out))
    return (ka.subtract(kb).withColumn("direction", F.lit("a_not_b"))
              .unionByName(kb.subtract(ka).withColumn("direction", F.lit("b_not_a"))))


def changed_cells(before: DataFrame, after: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """IO4: per column, how many cells of two states of a table differ (NULL equals NULL), how many of them were filled
    and how many emptied.  Rows are matched by ``key``, which must be unique; rows of one side only do not count."""
    side = lambda df, mark: df.select(key, *[F.col(c).alias(f"{mark}{c}") for c in cols])
    both = side(before, "b_").join(side(after, "a_"), key)
    was, now = (lambda c: F.col(f"b_{c}")), (lambda c: F.col(f"a_{c}"))
    counts = both.agg(*[F.struct(F.count_if(~was(c).eqNullSafe(now(c))).alias("n_changed"),
                                 F.count_if(was(c).isNull() & now(c).isNotNull()).alias("n_filled"),
                                 F.count_if(was(c).isNotNull() & now(c).isNull()).alias("n_emptied")).alias(c) for c in cols])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("n")) for c in cols])).alias("r")) \
        .select("r.variable", "r.n.*")


def range_reject(df: DataFrame, invalid) -> DataFrame:
    """DQ10: ``status`` = 'rejected' where the predicate is TRUE; NULL predicate rows are kept."""
    return df.withColumn("status", F.when(invalid, F.lit("rejected")).otherwise(F.lit("kept")))
