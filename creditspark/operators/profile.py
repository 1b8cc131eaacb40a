"""Distribution summaries (AG1-AG14): the data behind the reference's tables and plots.

Many variables are profiled in ONE pass: columns are unpivoted to
(variable, value) and grouped by variable, instead of one scan per column.
Quantiles are exact (type 7) by ``quantiles.grouped_quantiles``, whatever the size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditspark.functions.columns import cut_index
from creditspark.operators.cache import persist
from creditspark.operators.comoments import correlations
from creditspark.operators.quantiles import _join_null_safe, grouped_quantiles


def numeric_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    """FL5: numeric columns from the schema (no job), minus key/label columns named in ``exclude``."""
    from pyspark.sql.types import NumericType
    exclude = set(exclude or [])
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def long_numeric(df: DataFrame, cols: list[str], ids: list[str] | None = None) -> DataFrame:
    ids = ids or []
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot(ids, cols, "variable", "value")


def class_counts(df: DataFrame, col: str) -> DataFrame:
    """AG1: ``table(x)`` including the NULL class."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def class_shares(df: DataFrame, col: str) -> DataFrame:
    """AG2: ``prop.table``: counts divided by the total, a one-row aggregate of the counts."""
    total = F.lit(df.count())
    return class_counts(df, col).withColumn("share", F.col("n").cast("double") / total)


def six_number(df: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """AG3: (variable, n, min, q1, median, mean, q3, max), NULLs skipped."""
    by = by or []
    long = long_numeric(df, cols, by).filter(F.col("value").isNotNull())
    base = long.groupBy(*by, "variable").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("min"),
                                             F.avg("value").alias("mean"), F.max("value").alias("max"))
    q = grouped_quantiles(long, [*by, "variable"], "value", [0.25, 0.5, 0.75])
    return _join_null_safe(base, q, [*by, "variable"]).select(
        *by, "variable", "n", "min", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), "mean", F.col("q")[2].alias("q3"), "max")


def medians(df: DataFrame, cols: list[str]) -> DataFrame:
    """AG4: (variable, median), NULLs skipped."""
    q = grouped_quantiles(long_numeric(df, cols), ["variable"], "value", [0.5])
    return q.select("variable", F.col("q")[0].alias("median"))


def percentile_profile(df: DataFrame, cols: list[str], steps: int = 100) -> DataFrame:
    """AG5: ``quantile(x, seq(0, 1, 1/steps))`` per variable: (variable, pct, value)."""
    prof = grouped_quantiles(long_numeric(df, cols), ["variable"], "value", [i / steps for i in range(steps + 1)])
    return prof.select("variable", F.posexplode("q").alias("pct", "value"))


def box_stats(df: DataFrame, cols: list[str], by: list[str] | None = None, coef: float = 1.5) -> DataFrame:
    """AG6/AG7: quartiles, 1.5*IQR whiskers (extreme values inside the fence) and outlier count.

    Pass 1 computes the quartiles per (group, variable) - a small table;
    pass 2 joins it back for the fences.  Without ``by`` the quartile table has
    one row per variable and is broadcast; with ``by`` its size depends on the
    data, so the join strategy is left to AQE's measured-size check.
    """
    by = by or []
    long = long_numeric(df, cols, by).filter(F.col("value").isNotNull())
    qs = grouped_quantiles(long, [*by, "variable"], "value", [0.25, 0.5, 0.75])
    qs = qs.select(*by, "variable", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
                   F.col("q")[2].alias("q3"))
    qs = qs.withColumn("iqr", F.col("q3") - F.col("q1")) \
        .withColumn("lo_fence", F.col("q1") - F.lit(coef) * F.col("iqr")) \
        .withColumn("hi_fence", F.col("q3") + F.lit(coef) * F.col("iqr"))
    j = _join_null_safe(long, qs if by else F.broadcast(qs), [*by, "variable"])
    inside = (F.col("value") >= F.col("lo_fence")) & (F.col("value") <= F.col("hi_fence"))
    st = j.groupBy(*by, "variable").agg(
        F.min(F.when(inside, F.col("value"))).alias("lower_whisker"),
        F.max(F.when(inside, F.col("value"))).alias("upper_whisker"),
        F.count_if(~inside).cast("long").alias("n_outliers"),
        F.count(F.lit(1)).alias("n"))
    return _join_null_safe(qs, st, [*by, "variable"]).select(
        *by, "variable", "n", "q1", "median", "q3", "iqr", "lower_whisker", "upper_whisker", "n_outliers")


def bar_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """AG8: (variable, value, n) per categorical level, NULL kept as a level."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "variable", "value")
    return long.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))


def stacked_counts(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """AG9: (variable, value, label, n)."""
    long = df.select(label, *[F.col(c).cast("string").alias(c) for c in cols]) \
        .unpivot([label], cols, "variable", "value")
    return long.groupBy("variable", "value", label).agg(F.count(F.lit(1)).alias("n"))


def default_rate(df: DataFrame, cat_cols: list[str], label: str,
                 breaks: dict[str, list[float]] | None = None) -> DataFrame:
    """AG10: (variable, value, n, n_bad, default_rate) for categories and cut() bins, one pass."""
    breaks = breaks or {}
    proj = [F.col(c).cast("string").alias(c) for c in cat_cols]
    proj += [cut_index(c, b).cast("string").alias(c) for c, b in breaks.items()]
    names = cat_cols + list(breaks)
    lab = df.filter(F.col(label).isNotNull()).select(label, *proj)
    long = lab.unpivot([label], names, "variable", "value")
    return long.groupBy("variable", "value").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(label)).cast("long").alias("n_bad"),
        F.avg(F.col(label).cast("double")).alias("default_rate"))


def histogram(df: DataFrame, col: str, bins: int = 30, spark: SparkSession | None = None) -> DataFrame:
    """AG11: equal-width bins over [min, max], last bin closed; empty bins emitted with 0."""
    df = persist(df.select(col))
    x = F.col(col).cast("double")
    mm = df.agg(F.min(x).alias("mn"), F.max(x).alias("mx")).first()
    mn, mx = mm["mn"], mm["mx"]
    spark = spark or df.sparkSession
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    if mn is None:
        return grid.select("bin", F.lit(None).cast("double").alias("lo"),
                           F.lit(None).cast("double").alias("hi"), F.lit(0).cast("long").alias("n"))
    width = (mx - mn) / bins if mx > mn else 1.0
    b = F.least(F.floor((x - F.lit(mn)) / F.lit(mx - mn if mx > mn else 1.0) * F.lit(bins)).cast("int"),
                F.lit(bins - 1))
    counts = df.filter(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return (grid.join(counts, "bin", "left")
            .select("bin", (F.lit(mn) + F.col("bin") * F.lit(width)).alias("lo"),
                    (F.lit(mn) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def corr_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """AG12: pairwise-complete Pearson correlations (var_x before var_y in list order), one pass for any number of
    columns (``comoments.correlations``)."""
    return correlations(df, cols)


def count_above_below(df: DataFrame, col: str, threshold: float) -> DataFrame:
    """AG13: strict counts on both sides (equality is in neither)."""
    x = F.col(col)
    return df.agg(F.count_if(x > F.lit(threshold)).cast("long").alias("n_above"),
                  F.count_if(x < F.lit(threshold)).cast("long").alias("n_below"),
                  F.count_if(x == F.lit(threshold)).cast("long").alias("n_equal"))


def distinct_levels(df: DataFrame, col: str) -> DataFrame:
    """AG14: ``levels(factor(x))``: sorted distinct non-NULL values."""
    return df.select(F.col(col).cast("string").alias("level")).filter(F.col("level").isNotNull()) \
        .distinct().orderBy("level")
