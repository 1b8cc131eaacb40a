"""Cases that once gave wrong numbers, lost rows or crashed."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditspark.operators import cache, evaluate, irls, models, profile, quality, sampling, scorecard
from creditspark.operators.prep import Standardizer
from creditspark.sources.io import read_csv


@pytest.mark.parametrize("lam", [0.01, 0.3, 1, 5, 15.5, 16.5, 100, 745.2, 5000, 1e6])
def test_replication_counts_have_their_mean(spark, lam):
    n = 4000
    u = sampling.md5_uniform("id", "x")
    c = spark.range(n).select(sampling.replication_count(u, lam).alias("c"))
    got = c.agg(F.avg("c")).first()[0]
    assert abs(got - lam) <= 4 * math.sqrt(min(lam, 16) / n) + 1e-9


@pytest.mark.parametrize("rate", [0.1, 0.01, 0.0005])
def test_balancing_of_rare_classes(spark, rate):
    n = 6000
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") < max(2, round(n * rate))).cast("int").alias("y"), F.rand(1).alias("x"))
    with cache.scope():
        got = {r["y"]: r["count"] for r in sampling.rose_balance(df, "k", "y", ["x"], shrink=0.0).groupBy("y").count().collect()}
    for c in (0, 1):
        assert abs(got[c] - n / 2) <= 4 * math.sqrt(n / 2)


def test_many_copies_are_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(sampling, "COPIES_PER_TASK", 7)
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 7), (4, 8), (5, 50)], "k int, n long")
    got = {}
    for r in sampling.replicate(df, "n", "copy").collect():
        got.setdefault(r["k"], []).append(r["copy"])
    assert {k: sorted(v) for k, v in got.items()} == {k: list(range(1, n + 1)) for k, n in ((2, 1), (3, 7), (4, 8), (5, 50))}


def test_split_keeps_rows_without_key(spark):
    df = spark.createDataFrame([(None if i % 3 == 0 else i, i % 2, f"row {i}") for i in range(400)], "k long, y int, x string")
    with cache.scope():
        out = sampling.stratified_split(df, "k", "y", 0.7, 1).collect()
    assert len(out) == 400 and sum(r["is_train"] for r in out) == 280


def test_null_keys_are_keys(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), (None, None), (1, "c"), (1, "c"), (2, "d")], "k int, v string")
    assert sorted((r["k"], r["v"]) for r in quality.duplicate_occurrences(df, ["k"]).collect() if r["k"]) == [(1, "c")]
    assert quality.duplicate_occurrences(df, ["k"]).filter("k is null").count() == 2
    assert [tuple(r) for r in quality.drop_ambiguous_keys(df, ["k"]).collect()] == [(2, "d")]


def _singular(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=400)
    y = (r.random(400) < 1 / (1 + np.exp(-1.5 * x))).astype(float)
    z = r.normal(size=400)
    return spark.createDataFrame([(float(a), float(a), 0.0, float(b), 3.0, float(t)) for a, b, t in zip(x, z, y)],
                                 "x double, copy double, zero double, z double, const double, y double")


def test_singular_candidates_are_aliased(spark):
    df = _singular(spark)
    one = models.fit_logit(df, ["x"], "y")
    names = ["x", "copy", "zero", "z", "const"]
    data = irls.array_design(models.assemble(df, names, "y"), "features", "y")
    gram = irls.gram_matrix(data, 5)
    fits = irls.batched_logit(data, [[0], [0, 1], [2], [0, 2, 4], [1, 0], [0, 3]], gram)
    assert all(f.converged for f in fits)
    for f in (fits[0], fits[1], fits[3], fits[4]):
        assert f.aic == pytest.approx(one.aic, rel=1e-7)
    assert fits[1].coefficients[1] == pytest.approx(one.coefficients[0], rel=1e-4) and math.isnan(fits[1].coefficients[2])
    null = -2 * sum(math.log(p) * n for p, n in ((q, c) for q, c in ((k / 400, k) for k in (df.filter("y = 1").count(), df.filter("y = 0").count())))) + 2
    assert fits[2].aic == pytest.approx(null, rel=1e-7)
    cache_ = models.DesignCache(df, names, "y")
    assert cache_.fit(["x", "copy", "zero"]).aic == pytest.approx(one.aic, rel=1e-7)


def test_stepwise_on_collinear_terms(spark):
    df = _singular(spark)
    names = ["x", "copy", "zero", "z", "const"]
    chosen, path = models.step_aic(df, names, "y")
    other, _ = models.step_aic(df, names, "y", batched=False)
    assert all(b[3] < a[3] for a, b in zip(path, path[1:]))
    best = models.fit_logit(df, ["x"], "y").aic
    both = models.fit_logit(df, ["x", "z"], "y").aic
    assert path[-1][3] == pytest.approx(min(best, both), rel=1e-7)
    drop = {"copy", "zero", "const"}
    assert set(chosen) - drop == set(other) - drop


@pytest.mark.parametrize("label", [0, 1])
def test_one_class_data(spark, label):
    df = spark.createDataFrame([(i / 10, label) for i in range(10)], "p double, y int")
    assert evaluate.auc(df, "p", "y").first()["auc"] is None
    assert evaluate.roc_curve(df, "p", "y").count() == 11
    assert evaluate.auc_by_group(df.withColumn("g", F.lit(1)), ["g"], "p", "y").first()["auc"] is None
    assert evaluate.decile_table(evaluate.roc_curve(df, "p", "y")).count() > 0
    assert evaluate.cutoff_sweep(df, "p", "y", [0.1, 0.5]).count() == 2
    assert scorecard.financials(df, "p", "y", 0.5).count() == 1
    assert scorecard.financials(df.limit(0), "p", "y", 0.5).first()["credit_loss_with_pct"] is None


def test_dotted_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Type.of.residence,No of `x`,n\nRented,,1\nNA,b,\n,c,3\n")
    got = read_csv(spark, str(tmp_path / "a.csv")).collect()
    assert [tuple(r) for r in got] == [("Rented", None, 1), (None, "b", None), (None, "c", 3)]


def test_pair_names_hold_any_text(spark):
    df = spark.createDataFrame([(1.0, 2.0, 4.0), (2.0, 1.0, 3.0), (3.0, 5.0, 1.0)], "x__1 double, c double, `d__` double")
    assert [(r["var_x"], r["var_y"]) for r in profile.corr_long(df, ["x__1", "c", "d__"]).collect()] == [("x__1", "c"), ("x__1", "d__"), ("c", "d__")]


def test_constant_columns_are_named(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (1.0, 3.0, None)], "a double, b double, c double")
    assert Standardizer(["a", "b", "c"]).fit(df).constant == ["a", "c"]


def test_blocks_are_released(spark):
    import __spark_entry__ as entry
    cache.clear(spark)
    for key in ("iv_ranking", "six_number", "roc_curve", "holdout_stability", "histogram"):
        with cache.scope():
            entry.queries()[key](spark, "/root/testdata/sf0.001").collect()
        assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty(), key


def test_one_caller_does_not_drop_anothers_blocks(spark):
    a, b = cache.persist(spark.range(10).filter("id > 3")), cache.persist(spark.range(10).filter("id > 3"))
    cache.release(a)
    assert b.storageLevel.useMemory
    cache.release(b)
    assert not b.storageLevel.useMemory


def test_quantiles_of_extreme_values(spark):
    from creditspark.operators.quantiles import grouped_quantiles
    rows = [("big", v) for v in (-1.7e308, 1.7e308, 0.0, 5e-324, 1e300)] + [("one", 2.5)] * 300 + [(None, float(i % 50)) for i in range(500)] + [("null", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: r["q"] for r in grouped_quantiles(df, ["g"], "v", probs, rows_per_bucket=2).collect()}
    want = {r["g"]: r["q"] for r in df.filter("v is not null").groupBy("g").agg(F.percentile("v", probs).alias("q")).collect()}
    assert got.keys() == want.keys()
    for g in want:
        assert got[g] == pytest.approx(want[g], rel=1e-12)
