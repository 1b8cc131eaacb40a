"""ML keys.

``glm_fit``, ``glm_summary`` and ``glm_score`` fit a logistic GLM that is
saturated on one categorical predictor, so its fitted probabilities are the
per-level default rates and its coefficients, standard errors and AIC have
closed forms - the oracle SQL computes those directly.  The remaining model
keys are checked rows-only (trees, SVMs, stepwise paths and CV do not have
SQL equivalents).
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from creditspark.functions.columns import predict_at
from creditspark.operators import hinge as H
from creditspark.operators import models as M
from creditspark.operators import trees as T
from creditspark.operators.cache import persist
from creditspark.operators import scorecard as SC
from creditspark.operators import svm as SVM
from creditspark.plans.catalog import r6, register
from creditspark.plans.modelling import build_design
from creditspark.plans.oracle_base import with_fixture
from creditspark.sources import fixtures as fx

NA_LEVEL = "NA"
# fixed values: settings of the models
RF_TREES, RF_MTRY = 350, 8
REJECT_TREES, REJECT_MTRY = 500, 5
RF_GRID = [7, 8, 9, 10]
GBT_ROUNDS = 193
CV_ROUNDS = 300
RFF_SIGMA = 0.022
RFF_COMPONENTS = 256
SVM_COSTS, SVM_SIGMAS, SVM_FOLDS = [1.0, 2.0, 3.0], [0.01, 0.02], 2
GBT_CUTOFF = 0.195
REJECT_CUTOFF, REJECT_TUNED_CUTOFF = 0.32, 0.27
CV_FOLDS = 5

_designs: dict = {}


def forget_designs() -> None:
    """Let the next model query build its design anew (bench)."""
    _designs.clear()


def _lab_levels(spark, d):
    mt = fx.modelling_table(spark, d).filter(F.col("tag").isNotNull())
    return mt.withColumn("lvl", F.coalesce(F.col("priority"), F.lit(NA_LEVEL))) \
             .withColumn("label", F.col("tag").cast("double"))


def _saturated(spark, d):
    """Logistic GLM on one-hot(priority) with the alphabetically last level as reference."""
    lab = _lab_levels(spark, d)
    si = StringIndexer(inputCol="lvl", outputCol="lvl_idx", stringOrderType="alphabetAsc")
    oh = OneHotEncoder(inputCol="lvl_idx", outputCol="features", dropLast=True)
    glr = GeneralizedLinearRegression(family="binomial", link="logit", labelCol="label", tol=1e-10,
                                      maxIter=100, regParam=0.0)
    data = persist(lab.select("lvl", "label"))  # IRLS makes one pass per iteration
    model = Pipeline(stages=[si, oh, glr]).fit(data)
    return lab, model


_GROUPS = """g AS (select coalesce(priority, 'NA') lvl, count(*) n, sum(tag) k, avg(cast(tag as double)) p
                 from lab group by 1)"""


@register("glm_fit", with_fixture("select lvl priority, round(p, 6) p_hat from g", _GROUPS))
def glm_fit(spark, d):
    """ML1: binomial-logit GLM; saturated on priority, fitted p = level default rate."""
    lab, model = _saturated(spark, d)
    levels = lab.select("lvl").distinct()
    return model.transform(levels).select(F.col("lvl").alias("priority"), r6("prediction", "p_hat"))


_SUMMARY_SQL = with_fixture(
    """select '(Intercept)' term, round(ln(r.p / (1 - r.p)), 5) estimate,
              round(sqrt(1 / (r.n * r.p * (1 - r.p))), 5) std_error,
              round(ln(r.p / (1 - r.p)) / sqrt(1 / (r.n * r.p * (1 - r.p))), 5) z_value, round(a.aic, 3) aic
       from ref r cross join aicq a
       union all
       select 'priority_' || g.lvl, round(ln(g.p / (1 - g.p)) - ln(r.p / (1 - r.p)), 5),
              round(sqrt(1 / (g.n * g.p * (1 - g.p)) + 1 / (r.n * r.p * (1 - r.p))), 5),
              round((ln(g.p / (1 - g.p)) - ln(r.p / (1 - r.p)))
                    / sqrt(1 / (g.n * g.p * (1 - g.p)) + 1 / (r.n * r.p * (1 - r.p))), 5), round(a.aic, 3)
       from g cross join ref r cross join aicq a where g.lvl <> r.lvl""",
    _GROUPS, "ref AS (select * from g where lvl = (select max(lvl) from g))",
    "aicq AS (select -2 * sum(k * ln(p) + (n - k) * ln(1 - p)) + 2 * count(*) aic from g)")


@register("glm_summary", _SUMMARY_SQL)
def glm_summary(spark, d):
    """ML2: coefficient table (estimate, std. error, z) and AIC of the saturated GLM."""
    _, model = _saturated(spark, d)
    labels = model.stages[0].labels
    glm = model.stages[-1]
    names = [f"priority_{lv}" for lv in labels[:-1]]
    fit = M.GlmFit(names, [float(x) for x in glm.coefficients], float(glm.intercept),
                   list(glm.summary.coefficientStandardErrors), list(glm.summary.tValues),
                   list(glm.summary.pValues), float(glm.summary.aic))
    t = fit.table(spark)
    return t.select("term", F.round("estimate", 5).alias("estimate"), F.round("std_error", 5).alias("std_error"),
                    F.round("z_value", 5).alias("z_value"), F.round(F.lit(fit.aic), 3).alias("aic"))


@register("glm_score", with_fixture(
    """select m.application_id, round(g.p, 6) p from mt m join g on g.lvl = coalesce(m.priority, 'NA')""",
    _GROUPS))
def glm_score(spark, d):
    """ML6: predicted default probability for every applicant, labelled or rejected."""
    _, model = _saturated(spark, d)
    mt = fx.modelling_table(spark, d).withColumn("lvl", F.coalesce(F.col("priority"), F.lit(NA_LEVEL)))
    return model.transform(mt.select("application_id", "lvl")).select("application_id", r6("prediction", "p"))


# ---------------------------------------------------------------- rows-only model keys (path B design)

def _files(spark, d):
    """Names, sizes and times of the tables that a design is built from."""
    jvm, out = spark.sparkContext._jvm, []
    for t in ("orders", "customer", "lineitem"):
        path = jvm.org.apache.hadoop.fs.Path(f"{d}/{t}.parquet")
        for f in path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path):
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def _design(spark, d):
    """The path B design, built once per session and state of the folder's files (it is written to the shared folder)."""
    key = (spark.sparkContext.applicationId, d, _files(spark, d))
    if key not in _designs:
        _designs[key] = build_design(fx.modelling_table(spark, d))
    return _designs[key]


def _holdout(des, pred, *cols):
    """All holdout rows; those with a NULL feature have no prediction."""
    return des.test.select("application_id", "tag").join(pred.select("application_id", *cols), "application_id", "left")


def _path_df(spark, path, cols):
    return spark.createDataFrame(path, cols)


@register("step_aic")
def step_aic(spark, d):
    """ML3: bidirectional stepwise AIC from the full model on the balanced training design."""
    des = _design(spark, d)
    _, path = M.step_aic(des.balanced, des.features, "tag")
    return _path_df(spark, [(int(s), a, t, float(v)) for s, a, t, v in path],
                    "step int, action string, term string, aic double")


@register("backward_pvalue")
def backward_pvalue(spark, d):
    """ML4: manual backward elimination by p-value (alpha 0.05) with the AIC path."""
    des = _design(spark, d)
    _, path = M.backward_pvalue(des.balanced, des.features, "tag")
    return _path_df(spark, [(int(s), t, p, float(a)) for s, t, p, a in path],
                    "step int, dropped string, p_value double, aic double")


@register("vif")
def vif(spark, d):
    """ML5: variance inflation factors of the full logistic model."""
    des = _design(spark, d)
    fit = M.fit_logit(des.balanced, des.features, "tag")
    return spark.createDataFrame(M.vif(des.balanced, fit), "variable string, vif double")


def _matrix(des, folds: int = 1):
    """The balanced rows as binned blocks; folds hash the applicant key, so copies of one applicant stay together."""
    return T.binned(des.balanced, des.features, "tag", "application_id", M.fold_column("application_id", folds) if folds > 1 else None)


def _rf(spark, d):
    des = _design(spark, d)
    return des, T.forest(_matrix(des), RF_TREES, RF_MTRY)


@register("rf_prob")
def rf_prob(spark, d):
    """ML7/ML8: random forest (350 trees, mtry 8) class-1 probability on the holdout."""
    des, model = _rf(spark, d)
    return _holdout(des, model.score(des.test, "application_id"), "prob")


@register("rf_importance")
def rf_importance(spark, d):
    """ML9: random forest importance (normalised impurity decrease), ranked."""
    return T.importance_table(spark, _rf(spark, d)[1])


def _gbt(spark, d):
    des = _design(spark, d)
    return des, T.boost(_matrix(des), T.Boost(rounds=GBT_ROUNDS))[0]


@register("gbt_prob")
def gbt_prob(spark, d):
    """ML10/ML12: boosted trees (eta .7, gamma 5, depth 3, child weight 2, 193 rounds): holdout probability, class at .195."""
    des, model = _gbt(spark, d)
    return _holdout(des, model.score(des.test, "application_id"), "prob").withColumn("pred", predict_at("prob", GBT_CUTOFF))


@register("gbt_importance")
def gbt_importance(spark, d):
    """ML12: boosted-tree importance by gain, ranked."""
    return T.importance_table(spark, _gbt(spark, d)[1])


@register("gbt_cv")
def gbt_cv(spark, d):
    """ML11: 5-fold CV of boosting: per round mean / sd validation log-loss and AUC, best round by AUC."""
    des = _design(spark, d)
    rows, best = T.boost_cv(_matrix(des, CV_FOLDS), T.Boost(rounds=CV_ROUNDS), CV_FOLDS)
    return spark.createDataFrame(
        [(r, ml, sl, ma, sa, r == best) for r, ml, sl, ma, sa in rows],
        "round int, mean_logloss double, sd_logloss double, mean_auc double, sd_auc double, is_best boolean")


@register("linear_svm")
def linear_svm(spark, d):
    """ML13: linear SVM on the full balanced training side (no 5 % cost sample needed)."""
    des = _design(spark, d)
    model = M.linear_svm(des.vectors("balanced"), "tag")
    return _holdout(des, model.transform(des.vectors("test")), F.col("prediction").cast("int").alias("pred"))


@register("rff_svm")
def rff_svm(spark, d):
    """ML14: RBF-kernel SVM via random Fourier features (sigma .022, 256 components) + linear SVM."""
    return _rff(_design(spark, d), RFF_SIGMA)


def _rff(des, sigma):
    model = H.fit(des.balanced, des.features, "tag", sigma, RFF_COMPONENTS)
    return _holdout(des, H.classify(des.test, des.features, "application_id", model), "pred")


def _svm_grid(des):
    return SVM.grid(des.balanced, des.features, "tag", M.fold_column("application_id", SVM_FOLDS), SVM_COSTS, SVM_SIGMAS, SVM_FOLDS, RFF_COMPONENTS)


@register("svm_grid_cv")
def svm_grid_cv(spark, d):
    """ML15: 2-fold cross-validated grid of the kernel SVM over cost and sigma: accuracy, kappa and largest duality gap per setting."""
    rows, _ = _svm_grid(_design(spark, d))
    return spark.createDataFrame(rows, "cost double, sigma double, accuracy double, kappa double, gap double")


@register("svm_cv_predict")
def svm_cv_predict(spark, d):
    """ML16: holdout classes by the kernel SVM with the grid's best cost and sigma."""
    des = _design(spark, d)
    _, (cost, sigma) = _svm_grid(des)
    model = SVM.fit(SVM.design(des.balanced, des.features, "tag"), [SVM.Setting(SVM.Map(len(des.features), sigma, RFF_COMPONENTS), cost)])[0]
    return _holdout(des, SVM.classify(des.test, des.features, "application_id", model), "pred")


def _grid(des, n_trees: int):
    """(matrix, [(mtry, accuracy, kappa)])"""
    m = _matrix(des, CV_FOLDS)
    return m, T.forest_cv(m, RF_GRID, n_trees, CV_FOLDS)


def _best_forest(des, n_trees: int):
    """The forest of the grid's best mtry (the first at equal accuracy), on all balanced rows."""
    m, table = _grid(des, n_trees)
    return T.forest(m, n_trees, max(table, key=lambda t: t[1])[0])


GRID = "mtry int, accuracy double, kappa double"


@register("grid_cv")
def grid_cv(spark, d):
    """ML15: 5-fold cross-validated grid over random-forest mtry: accuracy and kappa per setting."""
    return spark.createDataFrame(_grid(_design(spark, d), RF_TREES)[1], GRID)


@register("cv_predict")
def cv_predict(spark, d):
    """ML16: the cross-validated best model's holdout predictions."""
    des = _design(spark, d)
    return _holdout(des, _best_forest(des, RF_TREES).score(des.test, "application_id"), "prob")


def _augmented(spark, d):
    """Labelled rows and rejects, these with the class that the fitted path B model gives them at .51."""
    mt = fx.modelling_table(spark, d)
    des = _design(spark, d)
    fit = M.fit_logit(des.balanced, des.features, "tag")
    scored = des.encode(mt.filter(F.col("tag").isNull())).withColumn("p", fit.probability())
    tags = SC.infer_rejects(scored, "p", 0.51).select("application_id", "inferred_tag")
    both = mt.join(tags, "application_id", "left").withColumn("tag", F.coalesce("tag", "inferred_tag")).drop("inferred_tag")
    return build_design(both.filter(F.col("tag").isNotNull()))


@register("reject_retrain")
def reject_retrain(spark, d):
    """RJ4: rejects get tags inferred by the fitted model (p >= .51), join the labelled rows, and the logistic model
    is selected by AIC and refitted on the augmented population; coefficients with their VIF."""
    des = _augmented(spark, d)
    chosen, _ = M.step_aic(des.balanced, des.features, "tag")
    fit = M.fit_logit(des.balanced, chosen, "tag")
    factors = spark.createDataFrame(M.vif(des.balanced, fit), "term string, vif double")
    return fit.table(spark).withColumn("aic", F.lit(fit.aic)).join(F.broadcast(factors), "term", "left")


@register("reject_forest")
def reject_forest(spark, d):
    """RJ4: random forest (500 trees, mtry 5) on the augmented population: holdout probability, class at .32."""
    des = _augmented(spark, d)
    model = T.forest(_matrix(des), REJECT_TREES, REJECT_MTRY)
    return _holdout(des, model.score(des.test, "application_id"), "prob").withColumn("pred", predict_at("prob", REJECT_CUTOFF))


@register("reject_grid_cv")
def reject_grid_cv(spark, d):
    """RJ4: the 5-fold grid over mtry on the augmented population."""
    return spark.createDataFrame(_grid(_augmented(spark, d), REJECT_TREES)[1], GRID)


@register("reject_cv_predict")
def reject_cv_predict(spark, d):
    """RJ4: the best forest of that grid: holdout probability, class at .27."""
    des = _augmented(spark, d)
    pred = _best_forest(des, REJECT_TREES).score(des.test, "application_id")
    return _holdout(des, pred, "prob").withColumn("pred", predict_at("prob", REJECT_TUNED_CUTOFF))
