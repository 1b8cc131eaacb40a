"""The Fourier SVM against LinearSVC over the mapped rows, and what a pass reads."""

import math
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditspark.operators import hinge, models

FEATURES = ["a", "b", "c"]


def frame(spark, n=600, seed=7):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 3))
    y = ((x ** 2).sum(axis=1) + .8 * r.normal(size=n) > 2.5).astype(int)
    rows = [(i, *map(float, v), int(t)) for i, (v, t) in enumerate(zip(x, y))] + [(n, None, 1.0, 1.0, 1)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y int").repartition(3)


def test_steps_and_classes_of_linear_svc(spark):
    df = frame(spark)
    mapped = models.fourier_features(df.dropna(), FEATURES, .3, 40).withColumn("y", F.col("y").cast("double"))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", UserWarning)
        want = models.linear_svm(mapped.cache(), "y", max_iter=15)
        got = hinge.fit(df, FEATURES, "y", .3, 40, max_iter=15)
    assert got.history == pytest.approx(list(want.summary().objectiveHistory), rel=1e-9)
    assert np.allclose(got.coefficients, want.coefficients.toArray(), rtol=1e-6, atol=1e-8)
    classes = {r["id"]: int(r["prediction"]) for r in want.transform(mapped).select("id", "prediction").collect()}
    assert {r["id"]: r["pred"] for r in hinge.classify(df, FEATURES, "id", got).collect()} == classes


def test_passes_read_the_features_and_one_serves_a_turn(spark, monkeypatch):
    """The rows of a pass are the few features, however many components; rows far from the margin's bound are not mapped twice."""
    df = frame(spark)
    blocks = hinge.blocks_of(df, FEATURES, "y")
    assert blocks.agg(F.sum(F.octet_length("x") + F.octet_length("y"))).first()[0] == 600 * 8 * (len(FEATURES) + 1)
    passes, look = [], hinge._Loss.look
    monkeypatch.setattr(hinge._Loss, "look", lambda self, wanted: passes.append(1) or look(self, wanted))
    with pytest.warns(UserWarning, match="Fourier SVM"):
        m = hinge.fit(df, FEATURES, "y", .3, 300, max_iter=5)
    assert len(m.history) == 6 and len(passes) <= 9


def test_map_and_odd_columns(spark):
    x = np.random.default_rng(1).normal(size=(50, 3)) * 4
    f = hinge.Fourier(*models.fourier_matrix(3, .3, 40, 1))
    assert np.allclose(f(x), math.sqrt(2 / 40) * np.cos(x @ f.w + f.b), atol=1e-14, rtol=0)
    same = spark.createDataFrame([(i, 1.0, i % 2) for i in range(6)], "id long, a double, y int")
    m = hinge.fit(same, ["a"], "y", .3, 10)  # no column varies
    assert not m.coefficients.any()
    with pytest.raises(ValueError, match="no rows"):
        hinge.fit(same.filter("id < 0"), ["a"], "y", .3, 10)
    with pytest.raises(Exception, match="neither 0 nor 1"):
        hinge.fit(same.withColumn("y", F.lit(2)), ["a"], "y", .3, 10)


def test_single_precision_decides_no_row(spark):
    """Wide values make single precision useless: its bound must then send every such row to double precision."""
    df = frame(spark, 300).withColumn("a", F.col("a") * 1e5)
    mapped = models.fourier_features(df.dropna(), FEATURES, .3, 40).withColumn("y", F.col("y").cast("double"))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", UserWarning)
        want = models.linear_svm(mapped.cache(), "y", max_iter=5)
        got = hinge.fit(df, FEATURES, "y", .3, 40, max_iter=5)
    assert got.history == pytest.approx(list(want.summary().objectiveHistory), rel=1e-7)
