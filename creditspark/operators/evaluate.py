"""Model evaluation (EV1-EV12).

Conventions (from the reference):
* ROC-type curves (EV1, EV6-EV10) use class 1 (default) as positive and
  "score >= cutoff => predict 1"; cutoffs are the distinct scores,
  descending, plus a first row at +inf where nothing is predicted positive.
* Confusion-matrix metrics (EV2, EV3, EV11) use class 0 as positive, as the
  reference's confusionMatrix(..., positive = "0"), so there sensitivity is
  the share of goods kept and specificity the share of defaulters caught.
* A rate over an empty class is NULL: one-class data have no AUC and no tpr or fpr.

Scale: the curve is built from ``groupBy(score)`` (map-side combine) and a
bucketed running sum (``cumulative.running_totals``) - no global window over
row-level data.  The fixed-grid sweep buckets each score to its grid index
in one pass and accumulates at most 101 rows.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.ml.feature import Bucketizer

from creditspark.operators.cumulative import DEFAULT_BUCKETS, running_totals

INF = float("inf")


def _d(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def score_counts(df: DataFrame, score: str, label: str, quantize: int | None = None) -> DataFrame:
    """(score, pos, neg) per distinct score; NULL scores / labels are ignored.

    ``quantize``: round scores to that many decimals first (at most 10^q + 1
    cutoffs whatever the data size); default None keeps every distinct score.
    """
    s = F.col(score) if quantize is None else F.round(F.col(score), quantize)
    return (df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
              .groupBy(s.alias("cutoff"))
              .agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("pos"),
                   F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("long").alias("neg")))


def roc_points(df: DataFrame, score: str, label: str, n_buckets: int | None = DEFAULT_BUCKETS,
               quantize: int | None = None) -> DataFrame:
    """Per distinct score: cutoff, pos, neg, tp, fp, prev_tp, prev_fp, P, N (no +inf row)."""
    g = score_counts(df, score, label, quantize)
    r = running_totals(g, "cutoff", ["pos", "neg"], descending=True, n_buckets=n_buckets)
    return r.select("cutoff", "pos", "neg", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                    F.col("prev_pos").alias("prev_tp"), F.col("prev_neg").alias("prev_fp"),
                    F.col("total_pos").alias("P"), F.col("total_neg").alias("N"))


def _metrics(pts: DataFrame) -> DataFrame:
    tp, fp, P, N = F.col("tp"), F.col("fp"), F.col("P"), F.col("N")
    return pts.select(
        "cutoff", "tp", "fp", (N - fp).alias("tn"), (P - tp).alias("fn"),
        F.try_divide(_d(tp), _d(P)).alias("tpr"), F.try_divide(_d(fp), _d(N)).alias("fpr"), F.try_divide(_d(N - fp), _d(N)).alias("tnr"),
        F.try_divide(_d(tp + N - fp), _d(P + N)).alias("acc"), F.try_divide(_d(tp + fp), _d(P + N)).alias("rpp"),
        F.try_divide(((tp + fp) * 10 + P + N - 1).cast("long"), P + N).cast("long").alias("decile"))


def roc_curve(df: DataFrame, score: str, label: str, n_buckets: int | None = DEFAULT_BUCKETS,
              quantize: int | None = None) -> DataFrame:
    """EV1: (cutoff, tp, fp, tn, fn, tpr, fpr, tnr, acc, rpp, decile) incl. the +inf row.

    ``decile`` = ceil(10 * rpp) in exact integer arithmetic.
    """
    pts = roc_points(df, score, label, n_buckets, quantize)
    totals = score_counts(df, score, label, quantize).agg(F.sum("pos").cast("long").alias("P"),
                                                F.sum("neg").cast("long").alias("N"))
    first = totals.select(F.lit(INF).alias("cutoff"), F.lit(0).cast("long").alias("pos"),
                          F.lit(0).cast("long").alias("neg"), F.lit(0).cast("long").alias("tp"),
                          F.lit(0).cast("long").alias("fp"), F.lit(0).cast("long").alias("prev_tp"),
                          F.lit(0).cast("long").alias("prev_fp"), "P", "N")
    return _metrics(first.unionByName(pts))


def auc(df: DataFrame, score: str, label: str, n_buckets: int | None = DEFAULT_BUCKETS,
        quantize: int | None = None) -> DataFrame:
    """EV10: trapezoid area under the ROC curve (ties handled: a tied group is one segment)."""
    pts = roc_points(df, score, label, n_buckets, quantize)
    area = F.sum(_d("neg") * (_d("prev_tp") + _d("pos") / F.lit(2.0)))
    return pts.agg(F.try_divide(area, _d(F.max("P")) * _d(F.max("N"))).alias("auc"))


def auc_by_group(df: DataFrame, group_cols: list[str], score: str, label: str) -> DataFrame:
    """EV10 for many curves at once: (group..., auc) with one running-sum pass partitioned by group."""
    from creditspark.operators.cumulative import partitioned_running_totals
    g = (df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
           .groupBy(*group_cols, F.col(score).alias("cutoff"))
           .agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("pos"),
                F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("long").alias("neg")))
    r = partitioned_running_totals(g, group_cols, "cutoff", ["pos", "neg"], descending=True)
    area = F.sum(_d("neg") * (_d("prev_pos") + _d("pos") / F.lit(2.0)))
    return r.groupBy(*group_cols).agg(F.try_divide(area, _d(F.max("total_pos")) * _d(F.max("total_neg"))).alias("auc"))


def ks(curve: DataFrame) -> DataFrame:
    """EV6: KS = max(tpr - fpr) over the curve."""
    return curve.agg(F.max(F.col("tpr") - F.col("fpr")).alias("ks"))


def decile_table(curve: DataFrame) -> DataFrame:
    """EV7-EV9 per decile d = ceil(10 rpp), d >= 1:
    ks = max(tpr - fpr), gain = max tpr, cumulative lift = tpr / rpp at the last cutoff of d,
    decile lift = captured-defaulter rate of the decile's rows over the base rate.
    """
    c = curve.filter(F.col("decile") >= 1)
    n_all = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    out = c.groupBy("decile").agg(
        F.max(F.col("tpr") - F.col("fpr")).alias("ks"), F.max("tpr").alias("gain"),
        F.max_by(F.struct("tp", "fp", "tpr", "rpp"), F.col("rpp")).alias("l"),
        F.max(F.try_divide(_d(F.col("tp") + F.col("fn")), _d(n_all))).alias("base_rate"))
    w = Window.orderBy("decile")  # <= 10 rows
    prev_tp = F.coalesce(F.lag("l.tp").over(w), F.lit(0))
    prev_n = F.coalesce(F.lag(F.col("l.tp") + F.col("l.fp")).over(w), F.lit(0))
    return out.select(
        "decile", "ks", "gain", F.try_divide(F.col("l.tpr"), F.col("l.rpp")).alias("cum_lift"),
        F.try_divide(F.try_divide(_d(F.col("l.tp") - prev_tp), _d(F.col("l.tp") + F.col("l.fp") - prev_n)),
                     F.col("base_rate")).alias("decile_lift"))


def grid(n: int = 100, hi: float = 0.91, lo: float = 0.0) -> list[float]:
    """R ``seq(lo, hi, length = n)``."""
    return [lo + i * (hi - lo) / (n - 1) for i in range(n)]


def cutoff_sweep(df: DataFrame, score: str, label: str, cutoffs: list[float]) -> DataFrame:
    """EV2: (i, cutoff, tp, fp, tn, fn, sensitivity, specificity, accuracy) for each grid cutoff.

    One pass: each row's grid index = number of cutoffs <= score; counts per
    index (<= len(cutoffs) + 1 rows) are suffix-summed on the tiny table.
    Sensitivity/specificity with class 0 as positive (reference convention).
    """
    spark = df.sparkSession
    # grid index by binary search (Bucketizer): bucket j <=> cutoffs[j-1] <= x < cutoffs[j]
    splits = [float("-inf")] + [float(c) for c in cutoffs] + [float("inf")]
    rows = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()) \
        .select(_d(score).alias("__x"), F.col(label).alias("__y"))
    b = Bucketizer(splits=splits, inputCol="__x", outputCol="__idx").transform(rows)
    counts = (b.withColumnRenamed("__y", label)
                .groupBy(F.col("__idx").cast("int").alias("idx"))
                .agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("pos"),
                     F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("long").alias("neg")))
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("cutoff", T.DoubleType())])
    g = spark.createDataFrame([(i, float(c)) for i, c in enumerate(cutoffs)], schema)
    # a row with grid index idx is predicted 1 for cutoff i iff idx > i: suffix sums over idx
    w = Window.orderBy(F.col("idx").desc()).rowsBetween(Window.unboundedPreceding, 0)
    allidx = spark.range(len(cutoffs) + 1).select(F.col("id").cast("int").alias("idx"))
    suf = (allidx.join(counts, "idx", "left").na.fill(0, ["pos", "neg"])
           .select("idx", F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp")))
    # totals = suffix sums at idx 0 (window over the <= 101-row table)
    wall = Window.partitionBy(F.lit(1))
    suf = suf.withColumn("P", F.max("tp").over(wall)).withColumn("N", F.max("fp").over(wall))
    s = g.join(F.broadcast(suf), F.col("idx") == F.col("i") + 1, "inner")
    tp, fp, P, N = F.col("tp"), F.col("fp"), F.col("P"), F.col("N")
    tn, fn = N - fp, P - tp
    return s.select("i", "cutoff", tp.cast("long").alias("tp"), fp.cast("long").alias("fp"),
                    tn.cast("long").alias("tn"), fn.cast("long").alias("fn"),
                    F.try_divide(_d(tn), _d(N)).alias("sensitivity"), F.try_divide(_d(tp), _d(P)).alias("specificity"),
                    F.try_divide(_d(tp + tn), _d(P + N)).alias("accuracy"))


def confusion(df: DataFrame, pred: str, actual: str) -> DataFrame:
    """EV3: one aggregate pass -> counts, accuracy, sensitivity/specificity (positive class 0), kappa."""
    a, p = F.col(actual), F.col(pred)
    ok = a.isNotNull() & p.isNotNull()
    c = df.filter(ok).agg(
        F.count_if((p == 0) & (a == 0)).cast("long").alias("tn"),
        F.count_if((p == 0) & (a == 1)).cast("long").alias("fn"),
        F.count_if((p == 1) & (a == 0)).cast("long").alias("fp"),
        F.count_if((p == 1) & (a == 1)).cast("long").alias("tp"))
    return with_confusion_metrics(c)


def with_confusion_metrics(c: DataFrame) -> DataFrame:
    tn, fn, fp, tp = (_d(x) for x in ("tn", "fn", "fp", "tp"))
    n = tn + fn + fp + tp
    po = F.try_divide(tn + tp, n)
    pe = F.try_divide((tn + fn) * (tn + fp) + (fp + tp) * (fn + tp), n * n)
    return c.select("*", po.alias("accuracy"), F.try_divide(tn, tn + fp).alias("sensitivity"),
                    F.try_divide(tp, tp + fn).alias("specificity"),
                    F.try_divide(po - pe, F.lit(1.0) - pe).alias("kappa"))


def balanced_cutoffs(curve: DataFrame, lo: float = 0.1, hi: float = 1.0, digits: int = 2) -> DataFrame:
    """EV4: cutoffs in (lo, hi) where bround(acc) = bround(sens) = bround(spec) (curve convention)."""
    r = curve.filter((F.col("cutoff") > lo) & (F.col("cutoff") < hi)).select(
        F.bround("cutoff", digits).alias("cutoff"), F.bround("tpr", digits).alias("sensitivity"),
        F.bround("tnr", digits).alias("specificity"), F.bround("acc", digits).alias("accuracy"))
    return r.filter((F.col("accuracy") == F.col("sensitivity")) & (F.col("sensitivity") == F.col("specificity")))


def cutoff_candidates(sweep: DataFrame, tol: float) -> DataFrame:
    """EV5: sweep rows with |sens - spec| < tol, flagged where the gap is the sweep-wide minimum."""
    gap = F.abs(F.col("sensitivity") - F.col("specificity"))
    s = sweep.withColumn("gap", gap).withColumn("min_gap", F.min("gap").over(Window.partitionBy(F.lit(1))))
    return s.filter(F.col("gap") < tol).select("i", "cutoff", "sensitivity", "specificity", "gap",
                                               (F.col("gap") == F.col("min_gap")).alias("is_min"))
