"""End-to-end flows of the reference, on real fitted models.

A  applicant table -> data quality -> WOE/IV ranking -> CSV
B  encoded, split, balanced design -> stepwise logistic model -> holdout
   evaluation (curve, KS, AUC, deciles, cutoff sweep, confusion at the
   balanced cutoff)
C  rejected applicants -> inferred tags -> refit on the augmented population
   -> points scorecard -> approve/decline and financial benefit

Each flow returns small result DataFrames (the drivers of the reference's
printed tables); the heavy work stays in Spark jobs.

    python -m creditspark.plans.flows /root/testdata/sf0.01
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditspark.functions.columns import predict_at
from creditspark.operators import evaluate as E
from creditspark.operators import models as M
from creditspark.operators import quality as Q
from creditspark.operators import scorecard as SC
from creditspark.operators.cache import clear
from creditspark.plans import ranking
from creditspark.plans.modelling import CATEGORICAL, build_design
from creditspark.session import get_spark, scratch_path
from creditspark.sources import fixtures as fx
from creditspark.sources import io


def path_a(spark: SparkSession, sf_dir: str, csv_out: str | None = None) -> dict[str, DataFrame]:
    """Quality checks and the IV ranking, written as CSV (IO2)."""
    mt = fx.modelling_table(spark, sf_dir)
    clean = Q.drop_ambiguous_keys(mt, ["application_id"])
    rank = ranking.iv_ranking(clean, fx.NUMERIC_FEATURES, CATEGORICAL, "tag", min_share=0.03)
    csv_out = csv_out or scratch_path(spark, "iv-ranking-csv")
    io.write_csv(rank.orderBy("rank").coalesce(1), csv_out)
    return {"null_by_column": Q.null_by_column(mt), "target_null_rate": Q.target_null_rate(mt, "tag"),
            "iv_ranking": rank, "csv_path": spark.createDataFrame([(csv_out,)], "path string")}


def path_b(spark: SparkSession, sf_dir: str, gap_tol: float = 0.05):
    """Stepwise logistic model on the balanced design, evaluated on the holdout."""
    des = build_design(fx.modelling_table(spark, sf_dir))
    chosen, path = M.step_aic(des.balanced, des.features, "tag")
    fit = M.fit_logit(des.balanced, chosen, "tag")
    scored = des.test.withColumn("p", fit.probability())
    curve = E.roc_curve(scored, "p", "tag")
    sweep = E.cutoff_sweep(scored, "p", "tag", E.grid(100, 0.91))
    cands = E.cutoff_candidates(sweep, gap_tol)
    best = cands.filter("is_min").orderBy("cutoff").first() or sweep.orderBy(
        F.abs(F.col("sensitivity") - F.col("specificity"))).first()
    cutoff = float(best["cutoff"])
    conf = E.confusion(scored.withColumn("pred", predict_at("p", cutoff)), "pred", "tag")
    return {
        "design": des, "fit": fit, "cutoff": cutoff,
        "step_path": spark.createDataFrame([(int(s), a, t, float(v)) for s, a, t, v in path],
                                           "step int, action string, term string, aic double"),
        "coefficients": fit.table(spark), "ks": E.ks(curve), "auc": E.auc(scored, "p", "tag"),
        "deciles": E.decile_table(curve), "sweep": sweep, "confusion": conf,
        "vif": spark.createDataFrame(M.vif(des.balanced, fit), "variable string, vif double"),
    }


def path_c(spark: SparkSession, sf_dir: str, b: dict | None = None, infer_cutoff: float = 0.51,
           revenue_threshold: float = 338.0):
    """Reject inference with the path-B model, refit, scorecard and money."""
    b = b or path_b(spark, sf_dir)
    des, fit, cutoff = b["design"], b["fit"], b["cutoff"]
    mt = fx.modelling_table(spark, sf_dir)
    rejects = mt.filter(F.col("tag").isNull())
    rej_scored = des.encode(rejects).withColumn("p", fit.probability())
    inferred = SC.infer_rejects(rej_scored.select("application_id", "p"), "p", infer_cutoff)
    tags = inferred.select("application_id", F.col("inferred_tag").alias("tag_inferred"))
    augmented = (mt.join(tags, "application_id", "left")
                   .withColumn("tag", F.coalesce("tag", "tag_inferred")).drop("tag_inferred")
                   .filter(F.col("tag").isNotNull()))
    des2 = build_design(augmented)
    kept, elim_path = M.backward_pvalue(des2.balanced, des2.features, "tag")
    fit2 = M.fit_logit(des2.balanced, kept, "tag")
    population = des2.encode(mt).withColumn("p", fit2.probability())
    scored = SC.with_score(population, "p")
    cut_score = SC.cutoff_score(cutoff)
    labelled = scored.filter(F.col("tag").isNotNull())
    return {
        "inferred_counts": inferred.groupBy("inferred_tag").count(),
        "elimination_path": spark.createDataFrame(
            [(int(s), t, p, float(a)) for s, t, p, a in elim_path],
            "step int, dropped string, p_value double, aic double"),
        "coefficients": fit2.table(spark),
        "approve_decline": SC.approve_decline(scored, "score", cut_score),
        "score_by_population": SC.score_by_population(scored, "score", "tag"),
        "revenue_flag": SC.revenue_flag(scored.filter(F.col("tag").isNull()), "score", revenue_threshold),
        # the reference evaluated money on all labelled rows (training rows included); both are reported
        "financials": SC.financials(labelled, "p", "tag", cutoff),
        "financials_holdout": SC.financials(des2.test.withColumn("p", fit2.probability()), "p", "tag", cutoff),
    }


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark()
    a = path_a(spark, sf_dir)
    a["iv_ranking"].orderBy("rank").show(truncate=False)
    b = path_b(spark, sf_dir)
    for k in ("step_path", "coefficients", "ks", "auc", "deciles", "confusion"):
        print(k)
        b[k].show(truncate=False)
    print("cutoff", b["cutoff"])
    c = path_c(spark, sf_dir, b)
    for k in ("inferred_counts", "elimination_path", "approve_decline", "score_by_population", "revenue_flag",
              "financials", "financials_holdout"):
        print(k)
        c[k].show(truncate=False)
    clear(spark)


if __name__ == "__main__":
    main(sys.argv)
