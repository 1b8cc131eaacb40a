"""Reject inference, points scorecard and financial benefit (RJ1-RJ4, SC1-SC6, FN1-FN5).

All outputs are single aggregate passes or projections.  Money parameters
default to the reference's assumptions: Rs 5000 earned per good customer per
year, Rs 100000 lost per defaulter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditspark.functions.columns import points, points_scalar, predict_at
from creditspark.operators.evaluate import confusion

GAIN_GOOD = 5000.0
LOSS_BAD = 100000.0


def _d(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def infer_rejects(rejects: DataFrame, p: str, cutoff: float = 0.51, out: str = "inferred_tag") -> DataFrame:
    """RJ3: inferred label for unlabelled rows: p >= cutoff -> 1 (default), else 0; NULL p stays NULL."""
    return rejects.withColumn(out, predict_at(p, cutoff))


def with_score(df: DataFrame, p: str, out: str = "score", **kw) -> DataFrame:
    """SC1: points = 400 + 20/ln2 * (ln odds(good) - ln 10)."""
    return df.withColumn(out, points(p, **kw))


def cutoff_score(p_cutoff: float = 0.46, **kw) -> float:
    """SC2: the score equivalent of a probability cutoff."""
    return points_scalar(p_cutoff, **kw)


def approve_decline(df: DataFrame, score: str, threshold: float) -> DataFrame:
    """SC4: strict counts above and below the cutoff score."""
    s = F.col(score)
    return df.agg(F.lit(threshold).alias("cutoff_score"),
                  F.count_if(s > F.lit(threshold)).cast("long").alias("n_above"),
                  F.count_if(s < F.lit(threshold)).cast("long").alias("n_below"))


def score_by_population(df: DataFrame, score: str, label: str) -> DataFrame:
    """SC5: approved (labelled) vs rejected (unlabelled) score comparison."""
    pop = F.when(F.col(label).isNull(), F.lit("rejected")).otherwise(F.lit("approved"))
    return df.groupBy(pop.alias("population")).agg(
        F.count(score).alias("n"), F.avg(score).alias("mean_score"),
        F.min(score).alias("min_score"), F.max(score).alias("max_score"))


def revenue_flag(rejects: DataFrame, score: str, threshold: float = 338.0,
                 revenue: float = GAIN_GOOD) -> DataFrame:
    """SC6: rejected applicants scoring >= threshold would have been good customers."""
    s = F.col(score)
    return rejects.agg(
        F.count(F.lit(1)).alias("n_rejects"),
        F.count_if(s >= F.lit(threshold)).cast("long").alias("n_flagged"),
        F.count_if(s.isNull()).cast("long").alias("n_unscored"),
        (F.count_if(s >= F.lit(threshold)).cast("double") * F.lit(revenue)).alias("revenue_loss"))


def profit_without_model(df: DataFrame, label: str, gain: float = GAIN_GOOD, loss: float = LOSS_BAD) -> DataFrame:
    """FN1: every applicant approved: goods earn ``gain``, defaulters cost ``loss``."""
    y = F.col(label)
    return df.agg(F.count_if(y == 0).cast("long").alias("n_good"), F.count_if(y == 1).cast("long").alias("n_bad")) \
        .withColumn("profit_without", _d("n_good") * F.lit(gain) - _d("n_bad") * F.lit(loss))


def financials(df: DataFrame, p: str, label: str, cutoff: float, gain: float = GAIN_GOOD,
               loss: float = LOSS_BAD) -> DataFrame:
    """FN1-FN5 in one aggregate pass over (prediction, actual).

    profit_with = TN*gain + TP*loss - FP*gain - FN*loss (positive = default);
    net gain and % gain vs approving everybody; revenue loss = good declined / all good;
    credit loss = defaulters approved / all applicants, without and with the model.
    A percentage of nothing is NULL.
    """
    c = confusion(df.withColumn("__pred", predict_at(p, cutoff)), "__pred", label)
    tn, fn, fp, tp = (_d(x) for x in ("tn", "fn", "fp", "tp"))
    n = tn + fn + fp + tp
    without = (tn + fp) * F.lit(gain) - (fn + tp) * F.lit(loss)
    with_m = tn * F.lit(gain) + tp * F.lit(loss) - fp * F.lit(gain) - fn * F.lit(loss)
    return c.select(
        "tn", "fn", "fp", "tp", without.alias("profit_without"), with_m.alias("profit_with"),
        (with_m - without).alias("net_gain"), F.try_divide((with_m - without) * F.lit(100.0), without).alias("pct_gain"),
        F.try_divide(fp * F.lit(100.0), tn + fp).alias("revenue_loss_pct"),
        F.try_divide((fn + tp) * F.lit(100.0), n).alias("credit_loss_without_pct"),
        F.try_divide(fn * F.lit(100.0), n).alias("credit_loss_with_pct"),
        F.try_divide(tp * F.lit(100.0), n).alias("credit_loss_saved_pct"))
