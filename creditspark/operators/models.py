"""Models (ML1-ML16) on ``pyspark.ml``.

* Logistic GLM: ``GeneralizedLinearRegression(binomial, logit)`` (IRLS; each
  iteration is one distributed pass).  Coefficient table, AIC, p-values come
  from the training summary.
* Stepwise AIC / backward elimination work on ONE assembled design that is
  checkpointed to the session's reliable checkpoint folder (survives executor
  loss and cuts lineage).  All candidates of a stepwise step are fitted
  together by batched IRLS (``irls.py``: one data pass per iteration);
  ``batched=False`` fits them as separate GLMs (column subsets by
  ``VectorSlicer``) from a driver thread pool.
* VIF: X'WX accumulated as one aggregate over rows ((k+1)(k+2)/2 sums),
  inverted on the driver (k x k, k = number of predictors).
* Trees: ``trees.py`` (histogram forests, second-order boosting and their
  cross-validation); ``RandomForestClassifier`` / ``GBTClassifier`` are offered beside it.
* Kernel SVM re-aimed as random Fourier features (Rahimi & Recht 2007):
  z(x) = sqrt(2/D) cos(xW + b) by one matrix product per Arrow batch, then ``LinearSVC``.
"""

from __future__ import annotations

import itertools
import math
import warnings
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier, LinearSVC, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.errors.exceptions.captured import IllegalArgumentException, UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditspark.operators.cache import persist, release
from creditspark.operators.trees import kappa  # noqa: F401 - callers take it from here
from creditspark.session import scratch_path

INTERCEPT = "(Intercept)"


# --------------------------------------------------------------------------- design

def assemble(df: DataFrame, features: list[str], label: str, out: str = "features",
             keep: list[str] | None = None) -> DataFrame:
    """Vector column + double label; rows with a NULL feature are dropped (glm's na.omit)."""
    keep = keep or []
    clean = df.dropna(subset=features + [label])
    va = VectorAssembler(inputCols=features, outputCol=out, handleInvalid="skip")
    return va.transform(clean).select(*keep, out, F.col(label).cast("double").alias(label))


def reliable(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read it back: cuts the lineage, survives lost executors and, unlike a
    checkpointed RDD, still reads only the columns that are asked for."""
    path = scratch_path(df.sparkSession, "design")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --------------------------------------------------------------------------- GLM (ML1, ML2, ML6)

@dataclass
class GlmFit:
    features: list[str]
    coefficients: list[float]
    intercept: float
    std_errors: list[float]
    t_values: list[float]
    p_values: list[float]
    aic: float
    model: object = None

    def table(self, spark: SparkSession) -> DataFrame:
        """Coefficient table (term, estimate, std_error, z_value, p_value); intercept first."""
        terms = [INTERCEPT] + self.features
        est = [self.intercept] + self.coefficients
        # summary arrays list the intercept last
        se = [self.std_errors[-1]] + self.std_errors[:-1]
        tv = [self.t_values[-1]] + self.t_values[:-1]
        pv = [self.p_values[-1]] + self.p_values[:-1]
        rows = [(t, float(e), float(s), float(z), float(p)) for t, e, s, z, p in zip(terms, est, se, tv, pv)]
        schema = "term string, estimate double, std_error double, z_value double, p_value double"
        return spark.createDataFrame(rows, schema)

    def linear_predictor(self) -> Column:
        expr = F.lit(self.intercept)
        for f, b in zip(self.features, self.coefficients):
            expr = expr + F.lit(float(b)) * F.col(f).cast("double")
        return expr

    def probability(self) -> Column:
        """ML6 as a pure column expression: 1 / (1 + exp(-x'b))."""
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.linear_predictor()))


def fit_logit_vector(design: DataFrame, label: str, features: list[str], features_col: str = "features",
                     tol: float = 1e-8, max_iter: int = 50) -> GlmFit:
    glr = GeneralizedLinearRegression(family="binomial", link="logit", labelCol=label, featuresCol=features_col,
                                      tol=tol, maxIter=max_iter, regParam=0.0, fitIntercept=True)
    design = persist(design)
    m = glr.fit(design)
    s = m.summary
    if s.numIterations >= max_iter:
        warnings.warn(f"the logistic fit of {len(features)} predictors had not converged after {max_iter} iterations", stacklevel=2)
    try:
        se, tv, pv = list(s.coefficientStandardErrors), list(s.tValues), list(s.pValues)
    except (IllegalArgumentException, UnsupportedOperationException):  # singular information matrix
        k = len(features) + 1
        se, tv, pv = [float("nan")] * k, [float("nan")] * k, [float("nan")] * k
    fit = GlmFit(features, [float(x) for x in m.coefficients], float(m.intercept), se, tv, pv, float(s.aic), m)
    release(design)  # the summary reads it
    return fit


def fit_logit(df: DataFrame, features: list[str], label: str, tol: float = 1e-8, max_iter: int = 50) -> GlmFit:
    """ML1/ML2: logistic GLM on named numeric predictors."""
    return fit_logit_vector(assemble(df, features, label), label, features, tol=tol, max_iter=max_iter)


# --------------------------------------------------------------------------- stepwise (ML3, ML4)

class DesignCache:
    """One checkpointed design with all candidate predictors; subsets via VectorSlicer."""

    def __init__(self, df: DataFrame, candidates: list[str], label: str):
        self.candidates, self.label = list(candidates), label
        from creditspark.operators.irls import array_design, gram_matrix
        self.design = reliable(assemble(df, candidates, label, out="all_features"))
        self.arrays = persist(array_design(self.design, "all_features", label))
        self.gram = gram_matrix(self.arrays, len(self.candidates))

    def independent(self, subset: list[str]) -> list[str]:
        """``subset`` without aliased terms."""
        from creditspark.operators.irls import independent
        return [self.candidates[i] for i in independent(self.gram, [self.candidates.index(c) for c in subset])]

    def fit(self, subset: list[str]) -> GlmFit | None:
        subset = self.independent(subset)
        if not subset:
            return None
        idx = [self.candidates.index(c) for c in subset]
        sl = VectorSlicer(inputCol="all_features", outputCol="features", indices=idx)
        try:
            return fit_logit_vector(sl.transform(self.design), self.label, list(subset))
        except (IllegalArgumentException, UnsupportedOperationException):  # rank deficiency: score as +inf AIC
            return None


def _aic(fit: GlmFit | None) -> float:
    return float("inf") if fit is None or fit.aic is None or math.isnan(fit.aic) else fit.aic


def step_aic(df: DataFrame, candidates: list[str], label: str, start: list[str] | None = None,
             parallelism: int = 4, batched: bool = True) -> tuple[list[str], list[tuple]]:
    """ML3: bidirectional stepwise selection by AIC (ties broken by term name).

    ``batched``: all candidate fits of a step share one pass per IRLS
    iteration (``irls.batched_logit``); otherwise each candidate is a
    separate GLM fit, run concurrently from a driver thread pool.
    An aliased term counts as absent, so it neither helps nor is dropped for nothing.
    Returns the chosen predictors and the path [(step, action, term, aic)].
    """
    from creditspark.operators.irls import batched_logit

    cache = DesignCache(df, candidates, label)
    current = list(start if start is not None else candidates)

    def aics(subsets: list[list[str]], pool) -> list[float]:
        if batched:
            fits = batched_logit(cache.arrays, [[candidates.index(c) for c in s] for s in subsets], cache.gram)
            return [f.aic if f.converged and np.isfinite(f.aic) else float("inf") for f in fits]
        return [_aic(f) for f in pool.map(cache.fit, subsets)]

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        best = aics([current], pool)[0]
        path = [(0, "start", None, best)]
        for step in itertools.count(1):  # every step lowers the AIC, so this ends
            moves = [("drop", c, [x for x in current if x != c]) for c in current if len(current) > 1]
            moves += [("add", c, current + [c]) for c in candidates if c not in current]
            scores = aics([m[2] for m in moves], pool)
            scored = sorted(((a, m[1], m[0], m[2]) for a, m in zip(scores, moves)), key=lambda t: (t[0], t[1]))
            if not scored or not scored[0][0] < best - 1e-9 * abs(best):
                break
            best, term, action, current = scored[0][0], scored[0][1], scored[0][2], scored[0][3]
            path.append((step, action, term, best))
    release(cache.arrays)
    return current, path


def backward_pvalue(df: DataFrame, features: list[str], label: str, alpha: float = 0.05) -> tuple[list[str], list[tuple]]:
    """ML4: refit without the term of largest p-value while it exceeds alpha.

    Returns the kept predictors and the path [(step, dropped_term, p_value, aic_after)].
    """
    cache = DesignCache(df, features, label)
    current = cache.independent(features)
    fit = cache.fit(current)
    path = [(0, None, None, _aic(fit))]
    for step in itertools.count(1):  # every step drops a term
        if fit is None or len(current) <= 1:
            break
        pv = fit.p_values[:-1]
        j = max(range(len(current)), key=lambda i: (pv[i] if not math.isnan(pv[i]) else 2.0, current[i]))
        if pv[j] <= alpha:
            break
        dropped = current[j]
        current = [c for c in current if c != dropped]
        fit = cache.fit(current)
        path.append((step, dropped, float(pv[j]), _aic(fit)))
    release(cache.arrays)
    return current, path


# --------------------------------------------------------------------------- VIF (ML5)

def vif(df: DataFrame, fit: GlmFit) -> list[tuple[str, float | None]]:
    """ML5: VIF_j = (R^-1)_jj with R the correlation form of vcov = (X'WX)^-1 (intercept removed)."""
    from creditspark.operators.irls import _reduce
    feats = fit.features
    data = df.dropna(subset=feats).select(F.array(*[F.col(f).cast("double") for f in feats]).alias("x"), F.lit(0.0).alias("y"))
    beta = np.array([fit.intercept, *fit.coefficients])
    xtwx = _reduce(data, [list(range(len(feats)))], [beta])[0][0]
    try:
        vcov = np.linalg.inv(xtwx)[1:, 1:]
        sd = np.sqrt(np.diag(vcov))
        r = vcov / np.outer(sd, sd)
        vals = np.diag(np.linalg.inv(r))
        return [(f, float(v)) for f, v in zip(feats, vals)]
    except np.linalg.LinAlgError:
        return [(f, None) for f in feats]


# --------------------------------------------------------------------------- trees (ML7-ML12)

def positive_probability(pred: DataFrame, col: str = "probability") -> Column:
    return vector_to_array(F.col(col))[1]


def random_forest(train: DataFrame, label: str, num_trees: int = 500, mtry: int | str = "sqrt",
                  seed: int = 100, max_depth: int = 10):
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=num_trees,
                                featureSubsetStrategy=str(mtry), seed=seed, maxDepth=max_depth)
    return rf.fit(train)


def boosted_trees(train: DataFrame, label: str, rounds: int = 193, step: float = 0.7, depth: int = 3,
                  colsample: float = 0.933, min_child: int = 2, gamma: float = 0.0, seed: int = 100):
    """ML10.  ``gamma`` is the least gain of a split (``minInfoGain``), on Spark's scale: variance reduction per row,
    not the booster's loss over all rows."""
    gbt = GBTClassifier(labelCol=label, featuresCol="features", maxIter=rounds, stepSize=step, maxDepth=depth,
                        subsamplingRate=1.0, featureSubsetStrategy=repr(colsample),
                        minInstancesPerNode=min_child, minInfoGain=gamma, seed=seed)
    return gbt.fit(train)


def importance_table(spark: SparkSession, model, features: list[str]) -> DataFrame:
    """ML9/ML12: normalised importances, ranked."""
    imp = model.featureImportances.toArray()
    rows = sorted(((f, float(v)) for f, v in zip(features, imp)), key=lambda t: (-t[1], t[0]))
    return spark.createDataFrame([(i + 1, f, v) for i, (f, v) in enumerate(rows)],
                                 "rank int, feature string, importance double")


def fold_column(key: str, k: int, seed: int = 0) -> Column:
    """Deterministic fold id from a hash of the key (independent of partitioning)."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(k)).cast("int")


def auc_per_round(model, valid: DataFrame, label: str, digits: int | None = None) -> dict[int, float | None]:
    """Validation AUC of the boosted model truncated after every round, without refitting.

    Each tree's prediction is added as a column and the running margins are one array per row (no shuffle).
    What is shuffled is one count per (round, margin) and task: rows in equal leaves have equal margins, and ties
    count half, as always.  ``digits`` rounds the margins first, which ties different ones.
    """
    from creditspark.operators.evaluate import auc_by_group
    df = valid.select("features", F.col(label).cast("int").alias(label))
    weights = list(model.treeWeights)
    for t, tree in enumerate(model.trees):
        df = tree.copy().setPredictionCol(f"__t{t}").transform(df)
    contrib = F.array(*[F.lit(float(w)) * F.col(f"__t{t}") for t, w in enumerate(weights)])
    running = F.aggregate(contrib, F.array().cast("array<double>"),
                          lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0)) + x)))
    margins = df.select(label, running.alias("__m")).select(label, F.posexplode("__m").alias("__r", "margin"))
    margin = F.col("margin") if digits is None else F.round("margin", digits).alias("margin")
    margins = margins.select(label, (F.col("__r") + 1).alias("round"), margin)
    return {r["round"]: r["auc"] for r in auc_by_group(margins, ["round"], "margin", label).collect()}


# --------------------------------------------------------------------------- SVMs (ML13, ML14)

def linear_svm(train: DataFrame, label: str, reg: float = 0.0, max_iter: int = 100):
    """ML13; ``max_iter`` turns without convergence are reported by a warning."""
    m = LinearSVC(labelCol=label, featuresCol="features", regParam=reg, maxIter=max_iter).fit(train)
    if m.hasSummary and m.summary().totalIterations >= max_iter:
        warnings.warn(f"the linear SVM had not converged after {max_iter} iterations", stacklevel=2)
    return m


def linear_margin(features: str, weights: list[float], intercept: float) -> Column:
    """ML13/ML14: margin of any fitted linear classifier on a vector column; class 1 where it is above 0."""
    terms = F.zip_with(vector_to_array(F.col(features)), F.array(*[F.lit(float(w)) for w in weights]), lambda x, w: x * w)
    return F.aggregate(terms, F.lit(0.0), lambda a, t: a + t) + F.lit(float(intercept))


def fourier_matrix(n_features: int, sigma: float, n_components: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """W_ij ~ N(0, 2 sigma) (variance) and b_j ~ U(0, 2 pi): parameters, drawn on the driver."""
    rng = np.random.default_rng(seed)
    return rng.normal(0.0, math.sqrt(2.0 * sigma), size=(n_features, n_components)), rng.uniform(0.0, 2 * math.pi, size=n_components)


def fourier_features(df: DataFrame, features: list[str], sigma: float, n_components: int = 256,
                     seed: int = 1, out: str = "features") -> DataFrame:
    """ML14: random Fourier map for the kernel exp(-sigma ||x - x'||^2), z(x) = sqrt(2/D) cos(x W + b), one
    matrix product per Arrow batch (256 column expressions would leave whole-stage code generation)."""
    w, b = fourier_matrix(len(features), sigma, n_components, seed)
    scale = math.sqrt(2.0 / n_components)

    @F.pandas_udf("array<double>")
    def mapped(x: pd.Series) -> pd.Series:
        return pd.Series(list(scale * np.cos(np.stack(x.to_numpy()) @ w + b)) if len(x) else [], dtype=object)

    return df.withColumn(out, array_to_vector(mapped(F.array(*[F.col(f).cast("double") for f in features]))))
