"""The Newton solver against a dense one, its gap as a bound, and its grid."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditspark.operators import svm

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data():
    r = np.random.default_rng(5)
    x = r.normal(size=(400, 3))
    y = ((x ** 2).sum(axis=1) + .5 * r.normal(size=400) > 2.5).astype(int)
    return x, y


def frame(spark, data):
    x, y = data
    rows = [(i, *map(float, v), int(t)) for i, (v, t) in enumerate(zip(x, y))] + [(400, None, 1.0, 1.0, 1)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y int").repartition(5)


def dense(z, y, cost):
    """The least objective, by many plain Newton steps with halving."""
    y, w = 2.0 * y - 1, np.zeros(z.shape[1])
    value = lambda w: w @ w / 2 + cost * (np.maximum(0, 1 - y * (z @ w)) ** 2).sum()
    for _ in range(200):
        slack = np.maximum(0, 1 - y * (z @ w))
        at = slack > 0
        step = np.linalg.solve(np.eye(len(w)) + 2 * cost * z[at].T @ z[at], w - 2 * cost * z[at].T @ (y[at] * slack[at]))
        t = 1.0
        while value(w - t * step) > value(w) and t > 1e-12:
            t /= 2
        w = w - t * step
    return value(w)


def test_objectives_and_gaps(spark, data):
    x, y = data
    maps = [svm.Map(3, None), svm.Map(3, .5, 40), svm.Map(3, .05, 40)]
    settings = [svm.Setting(m, c, f) for m in maps for c in (.1, 1.0, 10.0) for f in (-1, 0)]
    svm.fit(svm.design(frame(spark, data), FEATURES, "y", F.pmod("id", F.lit(2))), settings)
    for s in settings:
        rows = np.arange(400) % 2 != s.fold
        want = dense(s.map(x[rows]), y[rows], s.cost)
        assert s.objective == pytest.approx(want, rel=1e-6) and 0 <= s.gap + 1e-9 and s.objective - want <= s.gap + 1e-9 * want


def test_grid_and_classes(spark, data):
    df = frame(spark, data)
    rows, best = svm.grid(df, FEATURES, "y", F.pmod("id", F.lit(2)), [.5, 5.0], [None, .3], 2, 60)
    assert [r[:2] for r in rows] == [(.5, None), (5.0, None), (.5, .3), (5.0, .3)]
    assert best[1] == .3 and max(r[2] for r in rows) > .8 and all(r[4] < 1e-3 for r in rows)  # the classes are a ball and its outside
    s = svm.fit(svm.design(df, FEATURES, "y"), [svm.Setting(svm.Map(3, .3, 60), best[0])])[0]
    got = {r["id"]: r["pred"] for r in svm.classify(df, FEATURES, "id", s).collect()}
    assert len(got) == 400 and np.mean([got[i] == data[1][i] for i in range(400)]) > .85


def test_unfinished_settings_are_reported(spark, data):
    with pytest.warns(UserWarning, match="duality gap"):
        s = svm.fit(svm.design(frame(spark, data), FEATURES, "y"), [svm.Setting(svm.Map(3, .5, 40), 100.0)], max_turns=1)[0]
    assert s.gap > 0


def test_one_pass_a_turn_and_one_hessian_for_all_costs(spark, data, monkeypatch):
    passes, passed = [], svm._passed
    monkeypatch.setattr(svm, "_passed", lambda *a: passes.append(1) or passed(*a))
    settings = [svm.Setting(svm.Map(3, .5, 40), c) for c in (1.0, 2.0)]
    svm.fit(svm.design(frame(spark, data), FEATURES, "y"), settings)
    assert max(s.turns for s in settings) > 2 and len(passes) <= max(s.turns for s in settings) + 2
    alone = svm.fit(svm.design(frame(spark, data), FEATURES, "y"), [svm.Setting(svm.Map(3, .5, 40), 2.0)])[0]
    assert alone.turns == settings[1].turns and np.allclose(alone.w, settings[1].w)
