"""RJ, SC and FN keys on the fixed scorer."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from creditspark.functions.columns import points_slope
from creditspark.operators import prep, woe
from creditspark.operators import scorecard as SC
from creditspark.operators.profile import six_number
from creditspark.plans.catalog import r6, register
from creditspark.plans.oracle_base import CATEGORICAL, with_fixture
from creditspark.plans.queries_prep import CAPS_LOWER, CAPS_UPPER
from creditspark.plans.queries_woe import (APPLY_BODY, APPLY_CTES, MIN_SHARE, NULL_BEARING, REPLACE_BODY,
                                           REPLACE_CTES)
from creditspark.sources import fixtures as fx

CUTOFF = 0.46
INFER_CUTOFF = 0.51
REVENUE_THRESHOLD = 338.0
SLOPE = points_slope()
LN10 = math.log(10)
SCORE_SQL = f"(400.0 + '{SLOPE!r}'::double * (ln((1 - p) / p) - '{LN10!r}'::double))"
CUTOFF_SCORE = SC.cutoff_score(CUTOFF)
Z_COLS = ["tenure_days", "income", "price", "bal"]


def _scored_all(spark, d):
    return SC.with_score(fx.scored(spark, d, labelled_only=False), "p")


def _rejects_scored(spark, d):
    mt = fx.modelling_table(spark, d)
    return mt.filter(F.col("tag").isNull()).withColumn("p", fx.fixed_scorer())


@register("reject_prepare", with_fixture(
    """select a.application_id, a.woe_segment, a.woe_priority, a.woe_nation, r.n_trades, r.qty, r.util, r.bal
       from ap a join rp r on a.application_id = r.application_id
       join mt m on m.application_id = a.application_id where m.tag is null""",
    *APPLY_CTES, *REPLACE_CTES, f"ap AS ({APPLY_BODY})", f"rp AS ({REPLACE_BODY})"))
def reject_prepare(spark, d):
    """RJ1: rejected applicants encoded with the bins fitted on labelled applicants."""
    mt = fx.modelling_table(spark, d)
    model = woe.WoeBinner("tag", categorical=CATEGORICAL, numeric=NULL_BEARING, k=10, min_share=MIN_SHARE).fit(mt)
    rej = mt.filter(F.col("tag").isNull())
    out = model.transform(rej, prefix="woe_")
    return out.select("application_id", *[r6(f"woe_{c}", f"woe_{c}") for c in CATEGORICAL],
                      *[r6(f"woe_{c}", c) for c in NULL_BEARING])


def _union_sql():
    capped = ("select application_id, tag is null is_reject, tenure_days, "
              "case when income < 0.0 then 0.0 else income end income, price, "
              "case when bal > 500000.0 then 500000.0 else bal end bal from mt")
    zs = ", ".join(
        f"round((cast({c} as double) - avg(cast({c} as double)) over ()) / stddev_samp(cast({c} as double)) over (), 6) z_{c}"
        for c in Z_COLS)
    return with_fixture(f"select application_id, is_reject, {zs} from u", f"u AS ({capped})")


@register("reject_union", _union_sql())
def reject_union(spark, d):
    """RJ2: labelled and rejected rows unioned by name, capped, and rescaled together."""
    mt = fx.modelling_table(spark, d)
    u = prep.union_populations(mt.filter(F.col("tag").isNotNull()), mt.filter(F.col("tag").isNull()))
    caps = {c: v for c, v in CAPS_UPPER.items() if c in Z_COLS}
    capped = prep.WinsorCapper(upper=caps, lower=CAPS_LOWER).fit(u).transform(u)
    z = prep.Standardizer(Z_COLS).fit(capped).transform(capped, prefix="z_")
    return z.select("application_id", "is_reject", *[r6(f"z_{c}") for c in Z_COLS])


@register("reject_infer", with_fixture(
    f"""select application_id, round(p, 6) p,
               case when p is null then null when p >= {INFER_CUTOFF} then 1 else 0 end inferred_tag
        from (select application_id, round(1 / (1 + exp(-(0.000004*bal + 0.25*n_trades - 2.5))), 10) p
              from mt where tag is null) s"""))
def reject_infer(spark, d):
    """RJ3: inferred tag of rejected applicants: model probability >= 0.51 -> default."""
    out = SC.infer_rejects(_rejects_scored(spark, d), "p", INFER_CUTOFF)
    return out.select("application_id", r6("p"), "inferred_tag")


@register("points_score", with_fixture(
    f"select application_id, round(p, 6) p, round({SCORE_SQL}, 6) score from scored_all"))
def points_score(spark, d):
    """SC1: 400 points at odds 10:1, 20 points to double the odds."""
    return _scored_all(spark, d).select("application_id", r6("p"), r6("score"))


@register("score_summary", with_fixture(
    f"""select 'score' variable, count(*) n, round(min(s), 6) min, round(quantile_cont(s, 0.25), 6) q1,
               round(quantile_cont(s, 0.5), 6) median, round(avg(s), 6) mean,
               round(quantile_cont(s, 0.75), 6) q3, round(max(s), 6) max
        from (select {SCORE_SQL} s from scored_all) t"""))
def score_summary(spark, d):
    """SC3: summary of the application scores."""
    t = six_number(_scored_all(spark, d), ["score"])
    return t.select("variable", "n", *[r6(c) for c in ["min", "q1", "median", "mean", "q3", "max"]])


@register("approve_decline", with_fixture(
    f"""select round('{CUTOFF_SCORE!r}'::double, 6) cutoff_score,
               count(*) filter (where {SCORE_SQL} > '{CUTOFF_SCORE!r}'::double) n_above,
               count(*) filter (where {SCORE_SQL} < '{CUTOFF_SCORE!r}'::double) n_below from scored_all"""))
def approve_decline(spark, d):
    """SC2+SC4: score equivalent of p = 0.46 and the applicants above / below it."""
    t = SC.approve_decline(_scored_all(spark, d), "score", CUTOFF_SCORE)
    return t.select(r6("cutoff_score"), "n_above", "n_below")


@register("score_by_population", with_fixture(
    f"""select case when tag is null then 'rejected' else 'approved' end population, count(s) n,
               round(avg(s), 6) mean_score, round(min(s), 6) min_score, round(max(s), 6) max_score
        from (select tag, {SCORE_SQL} s from scored_all) t group by 1"""))
def score_by_population(spark, d):
    """SC5: score comparison between approved (labelled) and rejected applicants."""
    t = SC.score_by_population(_scored_all(spark, d), "score", "tag")
    return t.select("population", "n", r6("mean_score"), r6("min_score"), r6("max_score"))


@register("revenue_flag", with_fixture(
    f"""select count(*) n_rejects, count(*) filter (where s >= {REVENUE_THRESHOLD}) n_flagged,
               count(*) filter (where s is null) n_unscored,
               cast(count(*) filter (where s >= {REVENUE_THRESHOLD}) as double) * 5000.0 revenue_loss
        from (select {SCORE_SQL} s from
              (select round(1 / (1 + exp(-(0.000004*bal + 0.25*n_trades - 2.5))), 10) p
               from mt where tag is null) r) t"""))
def revenue_flag(spark, d):
    """SC6: rejected applicants scoring >= 338 and the yearly revenue they represent."""
    rej = SC.with_score(_rejects_scored(spark, d), "p")
    return SC.revenue_flag(rej, "score", REVENUE_THRESHOLD)


@register("profit_without", with_fixture(
    """select count(*) filter (where tag = 0) n_good, count(*) filter (where tag = 1) n_bad,
              cast(count(*) filter (where tag = 0) as double) * 5000.0
              - cast(count(*) filter (where tag = 1) as double) * 100000.0 profit_without from lab"""))
def profit_without(spark, d):
    """FN1: profit when every applicant is approved."""
    return SC.profit_without_model(fx.modelling_table(spark, d).filter(F.col("tag").isNotNull()), "tag")


_FIN = f"""fin AS (
  select tn, fn, fp, tp,
         cast(tn + fp as double) * 5000.0 - cast(fn + tp as double) * 100000.0 profit_without,
         cast(tn as double) * 5000.0 + cast(tp as double) * 100000.0
           - cast(fp as double) * 5000.0 - cast(fn as double) * 100000.0 profit_with,
         cast(tn + fn + fp + tp as double) n
  from (select count(*) filter (where p < {CUTOFF} and tag = 0) tn,
               count(*) filter (where p < {CUTOFF} and tag = 1) fn,
               count(*) filter (where p >= {CUTOFF} and tag = 0) fp,
               count(*) filter (where p >= {CUTOFF} and tag = 1) tp from scored) c)"""


def _fin(spark, d):
    return SC.financials(fx.scored(spark, d), "p", "tag", CUTOFF)


@register("profit_with", with_fixture(
    """select tn, fn, fp, tp, profit_without, profit_with, profit_with - profit_without net_gain,
              round((profit_with - profit_without) * 100.0 / profit_without, 6) pct_gain from fin""", _FIN))
def profit_with(spark, d):
    """FN2+FN3: profit with the model at cutoff 0.46, net gain and % gain over approving everybody."""
    return _fin(spark, d).select("tn", "fn", "fp", "tp", "profit_without", "profit_with", "net_gain",
                                 r6("pct_gain"))


@register("revenue_loss", with_fixture(
    "select tn, fp, round(cast(fp as double) * 100.0 / cast(tn + fp as double), 6) revenue_loss_pct from fin", _FIN))
def revenue_loss(spark, d):
    """FN4: share of good applicants the model declines."""
    return _fin(spark, d).select("tn", "fp", r6("revenue_loss_pct"))


@register("credit_loss", with_fixture(
    """select round(cast(fn + tp as double) * 100.0 / n, 6) credit_loss_without_pct,
              round(cast(fn as double) * 100.0 / n, 6) credit_loss_with_pct,
              round(cast(tp as double) * 100.0 / n, 6) credit_loss_saved_pct from fin""", _FIN))
def credit_loss(spark, d):
    """FN5: defaulters approved per applicant without and with the model, and the saving."""
    return _fin(spark, d).select(r6("credit_loss_without_pct"), r6("credit_loss_with_pct"),
                                 r6("credit_loss_saved_pct"))


@register("score_histogram", with_fixture(
    f"""select g.bin, round(mn + g.bin * (mx - mn) / 30, 6) lo, round(mn + (g.bin + 1) * (mx - mn) / 30, 6) hi,
               coalesce(c.n, 0) n
        from (select cast(range as integer) bin from range(0, 30)) g
        cross join mm
        left join (select least(cast(floor((s - mn) / (mx - mn) * 30) as integer), 29) bin, count(*) n
                   from sc cross join mm where s is not null group by 1) c on c.bin = g.bin""",
    f"sc AS (select {SCORE_SQL} s from scored_all)", "mm AS (select min(s) mn, max(s) mx from sc)"))
def score_histogram(spark, d):
    """SC3: 30-bin histogram of the application scores (AG11 on the score)."""
    from creditspark.operators.profile import histogram
    return histogram(_scored_all(spark, d), "score", 30).select("bin", r6("lo"), r6("hi"), "n")


def _score_box_sql():
    pop = "case when tag is null then 'rejected' else 'approved' end"
    fence = "value >= q1 - 1.5 * (q3 - q1) and value <= q3 + 1.5 * (q3 - q1)"
    return with_fixture(
        f"""select q.population, 'score' variable, s.n, round(q1, 6) q1, round(median, 6) median, round(q3, 6) q3,
                   round(q3 - q1, 6) iqr, round(lw, 6) lower_whisker, round(uw, 6) upper_whisker, s.n_outliers
            from q join (select u.population, count(*) n,
                                min(case when {fence} then value end) lw, max(case when {fence} then value end) uw,
                                cast(sum(case when {fence} then 0 else 1 end) as bigint) n_outliers
                         from u join q on u.population = q.population group by u.population) s
              on s.population = q.population""",
        f"u AS (select {pop} population, {SCORE_SQL} value from scored_all)",
        """q AS (select population, quantile_cont(value, 0.25) q1, quantile_cont(value, 0.5) median,
                        quantile_cont(value, 0.75) q3 from u group by population)""")


@register("score_box_by_population", _score_box_sql())
def score_box_by_population(spark, d):
    """SC5: boxplot statistics of the scores of approved vs rejected applicants (AG6/AG7 on the score)."""
    from creditspark.operators.profile import box_stats
    s = _scored_all(spark, d).withColumn(
        "population", F.when(F.col("tag").isNull(), F.lit("rejected")).otherwise(F.lit("approved")))
    t = box_stats(s, ["score"], by=["population"])
    return t.select("population", "variable", "n", r6("q1"), r6("median"), r6("q3"), r6("iqr"),
                    r6("lower_whisker"), r6("upper_whisker"), "n_outliers")
