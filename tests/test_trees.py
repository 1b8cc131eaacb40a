"""The tree engine against plain recursion, one way of growing against the other, and boosting against its own formulas."""

import math
import random

import numpy as np
import pytest

from creditspark.operators import trees as T

FEATURES = ["a", "b", "c"]


def rows(n=600, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = r.choice([0.0, 1.0, 2.5, 7.0]), r.gauss(0, 1), float(r.randint(0, 5))
        y = int(r.random() < 1 / (1 + math.exp(-(a - 2 + 2 * b * (c > 2)))))
        out.append((i, a, b, c, y))
    return out + [(n, None, 1.0, 1.0, 1), (n + 1, 1.0, 1.0, 1.0, None)]


def frame(spark, data):
    return spark.createDataFrame(data, "id long, a double, b double, c double, y int")


def matrix(spark, monkeypatch, spread, fold=None, data=None):
    from pyspark.sql import functions as F
    monkeypatch.setattr(T, "LOCAL_BYTES", 0 if spread else 1 << 30)
    monkeypatch.setattr(T, "BLOCK_ROWS", 100)
    df = frame(spark, rows() if data is None else data).repartition(4)
    return T.binned(df, FEATURES, "y", "id", None if fold is None else F.pmod("id", F.lit(fold)), n_bins=16)


def plain_tree(x, y, depth):
    """(feature, cut bin) by node of a heap, by trying every split of every node."""
    out = {}

    def impurity(ys):
        n, k = len(ys), sum(ys)
        return 2 * k * (n - k) / n if n else 0.0

    def go(node, at, left):
        ys = [y[i] for i in at]
        if not left or len(set(ys)) < 2:
            return
        best = None
        for f in range(len(x)):
            for cut in range(max(x[f]) + 1):
                lo, hi = [i for i in at if x[f][i] <= cut], [i for i in at if x[f][i] > cut]
                if lo and hi:
                    gain = impurity(ys) - impurity([y[i] for i in lo]) - impurity([y[i] for i in hi])
                    if gain > 1e-9 and (best is None or round(gain, 9) > round(best[0], 9)):
                        best = (gain, f, cut, lo, hi)
        if best:
            out[node] = (best[1], best[2], round(best[0], 6))
            go(2 * node, best[3], left - 1)
            go(2 * node + 1, best[4], left - 1)

    go(1, range(len(y)), depth)
    return out


@pytest.mark.parametrize("spread", [False, True])
def test_tree_against_plain_recursion(spark, monkeypatch, spread):
    m = matrix(spark, monkeypatch, spread)
    assert (m.local is None) == spread and m.rows == 600
    tree = T.grow(m, [T.Plan(0, 5, 3, sample=False)], depth=4)[0].trees[0]
    data = [r for r in rows() if None not in r]
    x = [[int(np.searchsorted(m.edges[f], r[f + 1], side="left")) for r in data] for f in range(3)]
    want = plain_tree(x, [r[4] for r in data], 4)
    assert {int(i): (int(tree.feature[i]), int(tree.cut[i]), round(float(tree.gain[i]), 6)) for i in np.flatnonzero(tree.feature >= 0)} == want


def test_both_ways_grow_the_same_forest(spark, monkeypatch):
    def grown(spread, hist):
        monkeypatch.setattr(T, "HIST_BYTES", hist)
        return T.grow(matrix(spark, monkeypatch, spread, fold=3), [T.Plan(f, t, 2, f) for f in range(2) for t in range(6)], depth=5)

    here, there = grown(False, 1 << 26), grown(True, 9_000)
    for f in here:
        for a, b in zip(here[f].trees, there[f].trees):
            assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and np.allclose(a.value, b.value)
    assert any((a.feature != b.feature).any() for a, b in zip(here[0].trees, here[0].trees[1:]))


def test_forest_cv_both_ways(spark, monkeypatch):
    got = [T.forest_cv(matrix(spark, monkeypatch, spread, fold=3), [1, 3], 8, 3, depth=4) for spread in (False, True)]
    assert got[0] == got[1] and [r[0] for r in got[0]] == [1, 3] and all(r[1] > .6 and r[2] > .2 for r in got[0])


def test_boosting_both_ways(spark, monkeypatch):
    monkeypatch.setattr(T, "KEEP", 3)
    s = T.Boost(rounds=8)
    here, there = (T.boost_cv(matrix(spark, monkeypatch, spread, fold=3), s, 3) for spread in (False, True))
    assert here[1] == there[1] and np.allclose(np.array(here[0]), np.array(there[0]))
    one, other = (T.boost(matrix(spark, monkeypatch, spread), s)[0] for spread in (False, True))
    assert np.allclose(one.importance(), other.importance())


def test_boosted_tree_is_a_newton_step(spark, monkeypatch):
    m = matrix(spark, monkeypatch, False)
    b, s = m.local.value, T.Boost(rounds=2, rule=T.Newton(least=2.0, gamma=0.5))
    first, second = T.boost(m, s)[0].trees
    margin = s.step * first.predict(b.bins)
    p = 1 / (1 + np.exp(-margin))
    leaf = second.leaves(b.bins)
    for i in np.unique(leaf):
        at = leaf == i
        assert np.isclose(second.value[i], -(p - b.y)[at].sum() / ((p * (1 - p))[at].sum() + 1)) and (p * (1 - p))[at].sum() >= 2
    assert (second.gain[second.feature >= 0] > 0).all()
    T_ = T.boost(m, T.Boost(rounds=1, rule=T.Newton(gamma=1e9)))[0].trees[0]
    assert (T_.feature < 0).all()  # no gain is enough


def test_scores_are_those_of_the_blocks(spark, monkeypatch):
    m = matrix(spark, monkeypatch, False)
    model = T.forest(m, 10, 2, depth=4)
    got = {r["id"]: r["prob"] for r in model.score(frame(spark, rows()), "id").collect()}
    assert len(got) == 601 and 600 not in got
    data = [r for r in rows() if None not in r]
    x = np.array([[np.searchsorted(m.edges[f], r[f + 1], side="left") for r in data] for f in range(3)], np.uint8)
    assert np.allclose([got[r[0]] for r in data], model.probability(x))
    assert abs(model.importance().sum() - 1) < 1e-9
    assert T.rank_auc(np.array([got[r[0]] for r in data]), np.array([r[4] for r in data], float)) > .8


def test_bootstrap_weights_are_poisson():
    w = T.bootstrap(np.arange(200_000, dtype=np.uint64), 3)
    assert abs(w.mean() - 1) < .01 and abs(w.var() - 1) < .02 and abs((w == 0).mean() - math.exp(-1)) < .005
    assert (T.subset(1, np.arange(1, 50), 10, 4).sum(axis=1) == 4).all()


def test_odd_tables(spark, monkeypatch):
    one = matrix(spark, monkeypatch, False, data=[(i, 1.0, 2.0, 3.0, 1) for i in range(5)])
    model = T.forest(one, 3, 2, depth=3)
    assert [r["prob"] for r in model.score(frame(spark, [(1, 0.0, 0.0, 9.0, None)]), "id").collect()] == [1.0]
    rows_, best = T.boost_cv(matrix(spark, monkeypatch, False, fold=2, data=[(i, float(i), 2.0, 3.0, 1) for i in range(6)]), T.Boost(rounds=2), 2)
    assert len(rows_) == 2 and best in (1, 2)
    none = matrix(spark, monkeypatch, False, data=[])
    assert none.rows == 0 and (T.forest(none, 2, 2, depth=2).trees[0].feature < 0).all()


def test_walk_and_draws_against_plain_ones():
    r = np.random.default_rng(4)
    bins = r.integers(0, 16, (3, 40_000)).astype(np.uint8)
    tree = T.Tree(7)
    inner = np.flatnonzero(r.random(128) < .8)
    tree.feature[inner], tree.cut[inner] = r.integers(0, 3, len(inner)), r.integers(0, 15, len(inner))
    for depth in (0, 3, 7):
        node = np.ones(bins.shape[1], int)
        for _ in range(depth):
            f = tree.feature[node]
            node = np.where(f >= 0, 2 * node + (bins[np.maximum(f, 0), np.arange(len(node))] > tree.cut[node]), node)
        assert (T.walk(tree.feature, tree.cut, depth, bins) == node).all()
    keys = r.integers(0, 1 << 63, 40_000).astype(np.uint64)
    u = (T.mixed(keys ^ T.mixed(np.uint64(9))) >> np.uint64(11)).astype(float) / 2.0 ** 53
    assert (T.bootstrap(keys, 9) == np.searchsorted(T._POISSON, u, side="right")).all()


@pytest.mark.parametrize("m", [1, 40])
def test_sums_of_many_rows(m):
    r = np.random.default_rng(6)
    bins, place = r.integers(0, 16, (3, 90_000)).astype(np.uint8), r.integers(0, m + 1, 90_000)
    w, y = r.integers(0, 4, 90_000).astype(float), r.integers(0, 2, 90_000).astype(float)
    got = T.counted(bins, place, w, y, m, 16)
    want = np.zeros((m + 1, 3, 16, 2))
    for f in range(3):
        np.add.at(want, (place, f, bins[f]), np.stack([w * y, w], axis=1))
    assert (got == want[:m]).all()


def test_a_forest_s_histograms_do_not_come_to_the_driver(spark, monkeypatch):
    def no(*_):
        raise AssertionError("histograms were collected")

    here = T.forest(matrix(spark, monkeypatch, False), 3, 2, depth=4)
    monkeypatch.setattr(T, "_added", no)
    there = T.forest(matrix(spark, monkeypatch, True), 3, 2, depth=4)
    assert all((a.feature == b.feature).all() and (a.g == b.g).all() and np.allclose(a.gain, b.gain) for a, b in zip(here.trees, there.trees))


def test_rounds_are_ranked_by_ranges_without_a_row_each(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(T, "_stored", lambda df, name, real=T._stored: stored.append(name) or real(df, name))
    s = T.Boost(rounds=3)
    here = T.boost_cv(matrix(spark, monkeypatch, False, fold=2), s, 2)
    monkeypatch.setattr(T, "RANKED_ROWS", 60, raising=False)
    monkeypatch.setattr(T, "KEEP", 2)
    there = T.boost_cv(matrix(spark, monkeypatch, True, fold=2), s, 2)
    assert here[1] == there[1] and np.allclose(np.array(here[0]), np.array(there[0]))
    assert set(stored) == {"binned", "margins"}


def test_cross_validation_brings_no_tree_to_the_driver(spark, monkeypatch):
    m = matrix(spark, monkeypatch, False, fold=3)
    monkeypatch.setattr(T.Tree, "unpack", lambda *_: pytest.fail("a tree was collected"))
    assert [r[0] for r in T.forest_cv(m, [1, 3], 4, 3, depth=3)] == [1, 3]


def test_trees_of_one_seed_share_their_rows():
    r = np.random.default_rng(8)
    bins, y = r.integers(0, 16, (4, 3000)).astype(np.uint8), r.integers(0, 2, 3000).astype(float)
    b, counted = T.Block(bins, y, r.integers(0, 1 << 63, 3000).astype(np.uint64), r.integers(0, 3, 3000).astype(np.uint8)), []
    real = T.sums
    T.sums = lambda bins, place, weights, m, n: counted.append(m) or real(bins, place, weights, m, n)
    try:
        plans = [T.Plan(i, 7, mtry, 1) for i, mtry in enumerate([2, 4, 3, 4])]
        alone = [T._grow_here(b, [p], T.Gini(), 6, 16)[0] for p in plans]
        apart = sum(counted)
        counted.clear()
        for one, other in zip(alone, T._grow_here(b, plans, T.Gini(), 6, 16)):
            assert all((getattr(one, c) == getattr(other, c)).all() for c in ("feature", "cut", "gain", "g", "h", "value"))
        assert sum(counted) < .75 * apart and any((x.feature != alone[1].feature).any() for x in alone)
    finally:
        T.sums = real


def test_a_table_copied_past_the_driver(spark, monkeypatch):
    here = matrix(spark, monkeypatch, False, fold=3)
    want = T.forest_cv(here, [1, 3], 4, 3, depth=4), T.boost_cv(here, T.Boost(rounds=3), 3), T.forest(here, 5, 2, depth=4)
    monkeypatch.setattr(T, "BLOCK_ROWS", 100)
    monkeypatch.setattr(T, "LOCAL_BYTES", 4000)
    from pyspark.sql import functions as F
    there = T.binned(frame(spark, rows()).repartition(4), FEATURES, "y", "id", F.pmod("id", F.lit(3)), n_bins=16)
    assert there.local is None and there.rows * (there.k + 10) > T.LOCAL_BYTES
    for name in ("_grow_spread", "_boost_spread"):
        monkeypatch.setattr(T, name, lambda *_: pytest.fail("grown in many jobs"))
    assert T.forest_cv(there, [1, 3], 4, 3, depth=4) == want[0]
    got = T.boost_cv(there, T.Boost(rounds=3), 3)
    assert got[1] == want[1][1] and np.allclose(np.array(got[0]), np.array(want[1][0]))
    assert all((a.feature == b.feature).all() and (a.cut == b.cut).all() for a, b in zip(T.forest(there, 5, 2, depth=4).trees, want[2].trees))
    numbers = sorted(r["i"] for r in there.everywhere("i long, n long", 7, lambda i, b: [{"i": i, "n": len(b.y)}]).collect() if r["n"] == 600)
    assert numbers == list(range(7))


def test_small_sums_of_boosting_need_no_shuffle(spark, monkeypatch):
    s, was = T.Boost(rounds=5), spark.conf.get(T.BATCH)
    want = T.boost(matrix(spark, monkeypatch, False), s)[0].importance()
    m, real = matrix(spark, monkeypatch, True), T._added
    monkeypatch.setattr(T, "WRITE", 2)
    monkeypatch.setattr(T, "_added", lambda *_: pytest.fail("a second stage"))
    assert np.allclose(T.boost(m, s)[0].importance(), want)
    calls = []
    monkeypatch.setattr(T, "_added", lambda *a: calls.append(spark.conf.get(T.BATCH)) or real(*a))
    monkeypatch.setattr(T, "SUMS_BYTES", 0)
    assert np.allclose(T.boost(m, s)[0].importance(), want) and set(calls) == {str(T.BLOCKS)}
    assert spark.conf.get(T.BATCH) == was


def test_boosting_cv_of_a_copied_table_with_an_empty_fold(spark, monkeypatch):
    want = T.boost_cv(matrix(spark, monkeypatch, False, fold=2), T.Boost(rounds=2), 3)
    m = matrix(spark, monkeypatch, True, fold=2)
    monkeypatch.setattr(T, "LOCAL_BYTES", 4000)
    assert m.local is None and m.travels
    monkeypatch.setattr(T, "_boost_spread", lambda *_: pytest.fail("a job per level"))
    got = T.boost_cv(m, T.Boost(rounds=2), 3)
    assert got[1] == want[1] and len(got[0]) == 2 and np.allclose(np.array(got[0]), np.array(want[0]))
