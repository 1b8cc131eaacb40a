"""EV keys on the fixed scorer (FIXTURES.md section 3): curves, sweeps, confusion, KS, gain, lift, AUC."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditspark.functions.columns import predict_at
from creditspark.operators import evaluate as E
from creditspark.operators import sampling as S
from creditspark.operators.cache import persist
from creditspark.plans.catalog import r6, register
from creditspark.plans.oracle_base import with_fixture
from creditspark.sources import fixtures as fx

CUTOFF = 0.46            # final model cutoff of the reference
GRID = E.grid(100, 0.91)  # seq(0, .91, length = 100)
GAP_TOL = 0.05
SEEDS = [100, 50, 25]
TRAIN_RATIO = 0.7


def _scored(spark, d):
    return fx.scored(spark, d, labelled_only=True)


_CURVE_CTES = [
    """g AS (select p cutoff, cast(sum(case when tag = 1 then 1 else 0 end) as bigint) pos,
                  cast(sum(case when tag = 1 then 0 else 1 end) as bigint) neg from scored group by p)""",
    """tot AS (select cast(sum(pos) as bigint) tot_pos, cast(sum(neg) as bigint) tot_neg from g)""",
    """pts AS (select cutoff,
                    cast(sum(pos) over (order by cutoff desc rows between unbounded preceding and current row)
                         as bigint) tp,
                    cast(sum(neg) over (order by cutoff desc rows between unbounded preceding and current row)
                         as bigint) fp from g
             union all select 'Infinity'::double, 0, 0)""",
    """cur AS (select cutoff, tp, fp, tot_neg - fp tn, tot_pos - tp fn,
                    cast(tp as double) / tot_pos tpr, cast(fp as double) / tot_neg fpr,
                    cast(tot_neg - fp as double) / tot_neg tnr,
                    cast(tp + tot_neg - fp as double) / (tot_pos + tot_neg) acc,
                    cast(tp + fp as double) / (tot_pos + tot_neg) rpp,
                    cast((10 * (tp + fp) + tot_pos + tot_neg - 1) // (tot_pos + tot_neg) as bigint) decile,
                    cast(tot_pos as double) / (tot_pos + tot_neg) base_rate
             from pts cross join tot)""",
]

_DECILE_CTE = """dec AS (
  select decile, ks, gain, tpr_l / rpp_l cum_lift,
         cast(tp_l - coalesce(lag(tp_l) over (order by decile), 0) as double)
           / cast(n_l - coalesce(lag(n_l) over (order by decile), 0) as double) / base_rate decile_lift
  from (select decile, max(tpr - fpr) ks, max(tpr) gain, arg_max(tpr, rpp) tpr_l, max(rpp) rpp_l,
               arg_max(tp, rpp) tp_l, arg_max(tp + fp, rpp) n_l, max(base_rate) base_rate
        from cur where decile >= 1 group by decile) s)"""


@register("roc_curve", with_fixture(
    """select round(cutoff, 6) cutoff, tp, fp, tn, fn, round(tpr, 6) tpr, round(fpr, 6) fpr, round(tnr, 6) tnr,
              round(acc, 6) acc, round(rpp, 6) rpp, decile from cur""", *_CURVE_CTES))
def roc_curve(spark, d):
    """EV1: ROC-type curve at every distinct score (bucketed running sums, no global window)."""
    c = E.roc_curve(_scored(spark, d), "p", "tag")
    return c.select(r6("cutoff"), "tp", "fp", "tn", "fn", r6("tpr"), r6("fpr"), r6("tnr"), r6("acc"), r6("rpp"),
                    "decile")


def _grid_cte():
    vals = ", ".join(f"({i}, '{c!r}'::double)" for i, c in enumerate(GRID))
    return f"grid AS (select * from (values {vals}) v(i, cutoff))"


_SWEEP_CTE = """sw AS (
  select i, cutoff, tp, fp, tot_neg - fp tn, tot_pos - tp fn,
         cast(tot_neg - fp as double) / tot_neg sensitivity, cast(tp as double) / tot_pos specificity,
         cast(tp + tot_neg - fp as double) / (tot_pos + tot_neg) accuracy
  from (select i, cutoff,
               cast(sum(case when p >= cutoff and tag = 1 then 1 else 0 end) as bigint) tp,
               cast(sum(case when p >= cutoff and tag = 0 then 1 else 0 end) as bigint) fp,
               cast(sum(case when tag = 1 then 1 else 0 end) as bigint) tot_pos,
               cast(sum(case when tag = 0 then 1 else 0 end) as bigint) tot_neg
        from grid cross join scored group by i, cutoff) s)"""


@register("cutoff_sweep", with_fixture(
    """select i, round(cutoff, 6) cutoff, tp, fp, tn, fn, round(sensitivity, 6) sensitivity,
              round(specificity, 6) specificity, round(accuracy, 6) accuracy from sw""", _grid_cte(), _SWEEP_CTE))
def cutoff_sweep(spark, d):
    """EV2: sensitivity/specificity/accuracy at 100 grid cutoffs from one pass over the scores."""
    s = E.cutoff_sweep(_scored(spark, d), "p", "tag", GRID)
    return s.select("i", r6("cutoff"), "tp", "fp", "tn", "fn", r6("sensitivity"), r6("specificity"),
                    r6("accuracy"))


_CONF_SELECT = """select tn, fn, fp, tp,
         round(cast(tn + tp as double) / (tn + fn + fp + tp), 6) accuracy,
         round(cast(tn as double) / (tn + fp), 6) sensitivity,
         round(cast(tp as double) / (tp + fn), 6) specificity,
         round((cast(tn + tp as double) / (tn + fn + fp + tp)
                - (cast(tn + fn as double) * (tn + fp) + cast(fp + tp as double) * (fn + tp))
                  / (cast(tn + fn + fp + tp as double) * (tn + fn + fp + tp)))
               / (1 - (cast(tn + fn as double) * (tn + fp) + cast(fp + tp as double) * (fn + tp))
                  / (cast(tn + fn + fp + tp as double) * (tn + fn + fp + tp))), 6) kappa"""

_CONF_COUNTS = f"""(select count(*) filter (where p < {CUTOFF} and tag = 0) tn,
                           count(*) filter (where p < {CUTOFF} and tag = 1) fn,
                           count(*) filter (where p >= {CUTOFF} and tag = 0) fp,
                           count(*) filter (where p >= {CUTOFF} and tag = 1) tp from scored) c"""


def _conf_out(c):
    return c.select("tn", "fn", "fp", "tp", r6("accuracy"), r6("sensitivity"), r6("specificity"), r6("kappa"))


@register("confusion", with_fixture(_CONF_SELECT + " from " + _CONF_COUNTS))
def confusion(spark, d):
    """EV3: confusion matrix at cutoff 0.46, accuracy, sensitivity/specificity (positive '0'), kappa."""
    s = _scored(spark, d).withColumn("pred", predict_at("p", CUTOFF))
    return _conf_out(E.confusion(s, "pred", "tag"))


@register("balanced_cutoff", with_fixture(
    """select round_even(cutoff, 2) cutoff, round_even(tpr, 2) sensitivity, round_even(tnr, 2) specificity,
              round_even(acc, 2) accuracy
       from cur where cutoff > 0.1 and cutoff < 1
         and round_even(acc, 2) = round_even(tpr, 2) and round_even(tpr, 2) = round_even(tnr, 2)""",
    *_CURVE_CTES))
def balanced_cutoff(spark, d):
    """EV4: cutoffs in (0.1, 1) where rounded accuracy = sensitivity = specificity."""
    return E.balanced_cutoffs(E.roc_curve(_scored(spark, d), "p", "tag"))


@register("cutoff_candidates", with_fixture(
    f"""select i, round(cutoff, 6) cutoff, round(sensitivity, 6) sensitivity, round(specificity, 6) specificity,
               round(gap, 6) gap, gap = min_gap is_min
        from (select *, abs(sensitivity - specificity) gap,
                     min(abs(sensitivity - specificity)) over () min_gap from sw) s
        where gap < {GAP_TOL}""", _grid_cte(), _SWEEP_CTE))
def cutoff_candidates(spark, d):
    """EV5: grid cutoffs with |sensitivity - specificity| < 0.05 and the minimum-gap flag."""
    s = E.cutoff_candidates(E.cutoff_sweep(_scored(spark, d), "p", "tag", GRID), GAP_TOL)
    return s.select("i", r6("cutoff"), r6("sensitivity"), r6("specificity"), r6("gap"), "is_min")


@register("ks", with_fixture("select round(max(tpr - fpr), 6) ks from cur", *_CURVE_CTES))
def ks(spark, d):
    """EV6: KS statistic max(tpr - fpr)."""
    return E.ks(E.roc_curve(_scored(spark, d), "p", "tag")).select(r6("ks"))


def _dec(spark, d):
    return E.decile_table(E.roc_curve(_scored(spark, d), "p", "tag"))


@register("ks_decile", with_fixture("select decile, round(ks, 6) ks from dec", *_CURVE_CTES, _DECILE_CTE))
def ks_decile(spark, d):
    """EV7: KS by decile of the population ranked by score."""
    return _dec(spark, d).select("decile", r6("ks"))


@register("gain", with_fixture("select decile, round(gain, 6) gain from dec", *_CURVE_CTES, _DECILE_CTE))
def gain(spark, d):
    """EV8: share of defaulters captured in the top deciles."""
    return _dec(spark, d).select("decile", r6("gain"))


@register("lift", with_fixture(
    "select decile, round(cum_lift, 6) cum_lift, round(decile_lift, 6) decile_lift from dec",
    *_CURVE_CTES, _DECILE_CTE))
def lift(spark, d):
    """EV9: cumulative and per-decile lift over a random model."""
    return _dec(spark, d).select("decile", r6("cum_lift"), r6("decile_lift"))


@register("auc", with_fixture(
    """select round(sum(cast(neg as double) * (cast(coalesce(prev_tp, 0) as double) + cast(pos as double) / 2))
                    / (cast(max(tot_pos) as double) * cast(max(tot_neg) as double)), 6) auc
       from (select pos, neg, sum(pos) over (order by cutoff desc rows between unbounded preceding
                                              and 1 preceding) prev_tp from g) s cross join tot""",
    *_CURVE_CTES))
def auc(spark, d):
    """EV10: area under the ROC curve (trapezoids, tie-correct)."""
    return E.auc(_scored(spark, d), "p", "tag").select(r6("auc"))


def _stability_sql():
    seeds = ", ".join(f"({s})" for s in SEEDS)
    return with_fixture(
        f"""select seed, count(*) n_test,
                   round(cast(sum(case when ok then 1 else 0 end) as double) / count(*), 6) accuracy,
                   round(cast(count(*) filter (where pred = 0 and tag = 0) as double)
                         / count(*) filter (where tag = 0), 6) sensitivity,
                   round(cast(count(*) filter (where pred = 1 and tag = 1) as double)
                         / count(*) filter (where tag = 1), 6) specificity,
                   cast(count(*) filter (where in100) as bigint) overlap_train100
            from (select t.seed, t.tag, case when s.p >= {CUTOFF} then 1 else 0 end pred,
                         (case when s.p >= {CUTOFF} then 1 else 0 end) = t.tag ok,
                         coalesce(tr.is_train, false) in100
                  from sp t join scored s on s.application_id = t.application_id
                  left join (select application_id, is_train from sp where seed = 100) tr
                    on tr.application_id = t.application_id and tr.is_train
                  where not t.is_train) x
            group by seed""",
        f"""sp AS (select application_id, tag, seed,
                         row_number() over (partition by seed, tag
                                            order by md5(cast(application_id as varchar) || '|' || cast(seed as varchar)),
                                                     application_id)
                           <= round_even({TRAIN_RATIO} * count(*) over (partition by seed, tag), 0) is_train
                  from lab cross join (values {seeds}) v(seed))""")


@register("holdout_stability", _stability_sql())
def holdout_stability(spark, d):
    """EV11: the cutoff-0.46 confusion metrics on the test side of splits with seeds 100, 50, 25,
    with the number of test rows that were training rows under seed 100."""
    mt = fx.modelling_table(spark, d).select("application_id", "tag", fx.fixed_scorer().alias("p"))  # no score: no bal
    splits = persist(S.stratified_split(mt, "application_id", "tag", TRAIN_RATIO, SEEDS))  # all seeds, one pass
    base = splits.filter((F.col("seed") == SEEDS[0]) & F.col("is_train")) \
        .select("application_id", F.lit(True).alias("in100"))
    test = splits.filter(~F.col("is_train") & F.col("p").isNotNull())
    t = test.join(base, "application_id", "left").withColumn("pred", predict_at("p", CUTOFF))
    m = t.groupBy("seed").agg(F.count(F.lit(1)).alias("n_test"),
                  F.avg((F.col("pred") == F.col("tag")).cast("double")).alias("accuracy"),
                  F.try_divide(F.count_if((F.col("pred") == 0) & (F.col("tag") == 0)).cast("double"),
                               F.count_if(F.col("tag") == 0).cast("double")).alias("sensitivity"),
                  F.try_divide(F.count_if((F.col("pred") == 1) & (F.col("tag") == 1)).cast("double"),
                               F.count_if(F.col("tag") == 1).cast("double")).alias("specificity"),
                  F.count_if(F.col("in100").isNotNull()).cast("long").alias("overlap_train100"))
    return m.select("seed", "n_test", r6("accuracy"), r6("sensitivity"), r6("specificity"), "overlap_train100")


@register("apply_cutoff", with_fixture(
    f"select application_id, round(p, 6) p, case when p >= {CUTOFF} then 1 else 0 end pred from scored_all"))
def apply_cutoff(spark, d):
    """EV12: class = 1 iff p >= 0.46."""
    s = fx.scored(spark, d, labelled_only=False)
    return s.select("application_id", r6("p"), predict_at("p", CUTOFF).alias("pred"))
