"""Batched IRLS: fit many logistic models (predictor subsets) in one pass per iteration.

Stepwise selection scores every single-term drop and add at each step.
Fitting those candidates one by one costs (candidates x iterations) passes
over the data.  Here each iteration is ONE pass: every partition computes,
for every candidate c, the partial sums X_c' W_c X_c, X_c' W_c z_c and the
log-likelihood at the current coefficients (numpy inside the task) and
emits one binary block per candidate; a few tasks add the blocks up and the
driver solves the (k+1) x (k+1) normal equations per candidate.

AIC = -2 loglik + 2 (k_c + 1), identical to the GLM summary at convergence.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPS = 1e-15
SCHEMA = "c int, block binary"
REDUCERS = 32


@dataclass
class BatchFit:
    indices: list[int]
    coefficients: np.ndarray   # intercept first
    std_errors: np.ndarray
    loglik: float
    aic: float
    converged: bool


def _partials(subsets: list[list[int]], betas: list[np.ndarray]):
    def fn(batches):
        acc = [(np.zeros((len(s) + 1, len(s) + 1)), np.zeros(len(s) + 1), 0.0) for s in subsets]
        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column(1).to_numpy()
            X = np.hstack([np.ones((len(y), 1)), batch.column(0).flatten().to_numpy().reshape(len(y), -1)])
            for c, (idx, b) in enumerate(zip(subsets, betas)):
                Xc = X[:, [0, *[i + 1 for i in idx]]]
                eta = Xc @ b
                p = np.clip(1.0 / (1.0 + np.exp(-eta)), EPS, 1 - EPS)
                w = p * (1 - p)
                z = eta + (y - p) / w
                A, g, ll = acc[c]
                acc[c] = (A + Xc.T @ (Xc * w[:, None]), g + Xc.T @ (w * z),
                          ll + float(np.sum(y * np.log(p) + (1 - y) * np.log(1 - p))))
        yield pa.record_batch({"c": pa.array(range(len(acc)), pa.int32()),
                               "block": pa.array([np.concatenate([A.ravel(), g, [ll]]).tobytes() for A, g, ll in acc], pa.binary())})
    return fn


def _summed(batches):
    """Blocks of one task, added up per candidate."""
    total: dict[int, np.ndarray] = {}
    for pdf in batches:
        for c, block in zip(pdf["c"], pdf["block"]):
            v = np.frombuffer(block)
            total[c] = total[c] + v if c in total else v.copy()
    yield pd.DataFrame([(c, v.tobytes()) for c, v in total.items()], columns=["c", "block"])


def _reduce(data: DataFrame, subsets, betas):
    """X'WX, X'Wz and the log-likelihood of every candidate: one block per candidate and task, added up by
    REDUCERS tasks (each task's blocks go to one of them), whose few sums the driver adds."""
    blocks = data.select("x", "y").mapInArrow(_partials(subsets, betas), SCHEMA).withColumn("r", F.pmod(F.spark_partition_id(), F.lit(REDUCERS)))
    out = [(np.zeros((len(s) + 1, len(s) + 1)), np.zeros(len(s) + 1), 0.0) for s in subsets]
    for r in blocks.repartition(REDUCERS, "r").select("c", "block").mapInPandas(_summed, SCHEMA).collect():
        v, m = np.frombuffer(r["block"]), len(subsets[r["c"]]) + 1
        A, g, ll = out[r["c"]]
        out[r["c"]] = (A + v[:m * m].reshape(m, m), g + v[m * m:m * m + m], ll + v[-1])
    return out


def independent(gram: np.ndarray, subset: list[int], tol: float = 1e-9) -> list[int]:
    """The columns of ``subset`` that are no combination of the constant and earlier ones, as ``glm`` aliases
    terms: elimination in the given order over ``gram`` (X'X with the constant first)."""
    order = [0] + [i + 1 for i in subset]
    a = gram[np.ix_(order, order)].astype(float)
    scale, kept = np.diag(a).copy(), []
    for j in range(len(order)):
        if a[j, j] <= tol * scale[j] or scale[j] <= 0:
            a[j, :] = a[:, j] = 0.0
            continue
        if j:
            kept.append(subset[j - 1])
        row = a[j].copy()
        for i in range(j + 1, len(order)):
            a[i] -= row * (row[i] / row[j])
    return kept


def array_design(design: DataFrame, features_col: str, label: str) -> DataFrame:
    """(x, y) rows for ``batched_logit``."""
    return design.select(vector_to_array(F.col(features_col)).alias("x"), F.col(label).cast("double").alias("y"))


def gram_matrix(data: DataFrame, k: int) -> np.ndarray:
    """X'X of all ``k`` columns with the constant first, in one pass over ``array_design`` rows."""
    return 4.0 * _reduce(data, [list(range(k))], [np.zeros(k + 1)])[0][0]


def batched_logit(data: DataFrame, wanted: list[list[int]], gram: np.ndarray, max_iter: int = 200, tol: float = 1e-9) -> list[BatchFit]:
    """Fit ``len(wanted)`` logistic models (columns of ``x`` by index) together.

    ``data`` is ``array_design``'s, persisted by the caller.  Dependent columns are aliased: the fit is that of the
    others, their coefficient is NaN and they do not count in the AIC.  Converged means that the deviance
    moved by less than ``tol`` of itself, as in ``glm``; whatever has not by ``max_iter`` is reported by a warning.
    """
    subsets = [independent(gram, s) for s in wanted]
    betas = [np.zeros(len(s) + 1) for s in subsets]
    active = [True] * len(subsets)
    last = [-np.inf] * len(subsets)
    for _ in range(max_iter):
        stats = _reduce(data, subsets, betas)
        active = [abs(ll - was) > tol * (abs(ll) + 0.1) for (_, _, ll), was in zip(stats, last)]
        last = [ll for _, _, ll in stats]
        if not any(active):
            break
        betas = [np.linalg.lstsq(A, g, rcond=None)[0] if on else b for (A, g, _), b, on in zip(stats, betas, active)]
    fits = []
    for c, (A, _, ll) in enumerate(stats):
        whole, se = np.full(len(wanted[c]) + 1, np.nan), np.full(len(wanted[c]) + 1, np.nan)
        at = [0] + [1 + wanted[c].index(i) for i in subsets[c]]
        whole[at], se[at] = betas[c], np.sqrt(np.abs(np.diag(np.linalg.pinv(A))))
        fits.append(BatchFit(wanted[c], whole, se, ll, -2 * ll + 2 * len(betas[c]), not active[c]))
    if any(active):
        warnings.warn(f"{sum(active)} of {len(active)} logistic fits had not converged after {max_iter} iterations", stacklevel=2)
    return fits
