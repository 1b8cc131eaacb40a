"""Correlations of many columns, limits of running sums, kernel noise and merges of many columns, against plain versions."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from creditspark.operators import comoments, cumulative, evaluate, profile, sampling, woe
from creditspark.sources import fixtures as fx


def _pairs(df, cols):
    return {(r["var_x"], r["var_y"]): r["corr"] for r in profile.corr_long(df, cols).collect()}


@pytest.mark.parametrize("partitions, fan", [(1, 256), (7, 2)])
def test_correlations_equal_pairwise_complete_ones(spark, monkeypatch, partitions, fan):
    monkeypatch.setattr(comoments, "FAN", fan)
    rng = np.random.default_rng(3)
    n, k = 700, 61     # 61 columns: two stripes
    x = rng.normal(size=(n, k)) @ rng.normal(size=(k, k)) + rng.normal(size=k) * 1e8
    x[rng.random((n, k)) < 0.2] = np.nan
    cols = [f"c{i}" for i in range(k)]
    pdf = pd.DataFrame(x, columns=cols)
    rows = [[None if math.isnan(v) else float(v) for v in r] for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(partitions)
    got, want = _pairs(df, cols), pdf.corr()
    assert len(got) == k * (k - 1) // 2
    assert max(abs(got[a, b] - want.loc[a, b]) for a, b in got) < 1e-6


def test_correlations_of_odd_columns(spark):
    rows = [(float(i), 0.1, None, float("inf") if i == 3 else float(i), None if i == 3 else float(-i), 1.0 if i == 5 else None) for i in range(9)]
    df = spark.createDataFrame(rows, "a double, flat double, none double, odd double, gap double, once double")
    got = _pairs(df.repartition(4), ["a", "flat", "none", "odd", "gap", "once"])
    assert got["a", "gap"] == pytest.approx(-1.0)
    assert math.isnan(got["a", "odd"])
    assert got["odd", "gap"] == pytest.approx(-1.0)    # the infinity's row has no gap
    assert all(got[p] is None for p in got if {"flat", "none", "once"} & set(p) and not ("odd" in p and "flat" in p))
    empty = _pairs(df.limit(0), ["a", "gap"])
    assert empty == {("a", "gap"): None}


def test_five_hundred_columns_are_one_pass(spark):
    cols = [f"c{i}" for i in range(500)]
    df = spark.range(400).select(*[F.sin(F.col("id") * (i + 1)).alias(c) for i, c in enumerate(cols)])
    found = profile.corr_long(df, cols)
    assert found.filter("corr is not null").count() == 500 * 499 // 2
    x = np.sin(np.arange(400)[:, None] * (np.arange(500) + 1))
    assert found.filter("var_x = 'c3' and var_y = 'c499'").first()["corr"] == pytest.approx(np.corrcoef(x[:, 3], x[:, 499])[0, 1], abs=1e-9)


@pytest.mark.parametrize("limits, x, want", [([], 1.0, 0), ([1.0], 0.5, 0), ([1.0], 1.0, 1), (list(range(11)), 4.5, 5), (list(range(11)), 99.0, 11),
                                             (list(range(16)), 15.0, 16)])
def test_binary_search_of_limits(spark, limits, x, want):
    df = spark.createDataFrame([([float(v) for v in limits], x)], "l array<double>, x double")
    assert df.select(cumulative._count_at_most(F.col("l"), F.col("x"), 16).alias("n")).first()["n"] == want


def test_running_totals_of_groups_in_many_ranges(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": np.where(np.arange(3000) < 2000, "hot", "cold" + pd.Series(np.arange(3000) % 5).astype(str)),
                        "s": np.exp(rng.normal(size=3000) * 20), "v": rng.integers(0, 9, 3000)})
    df = spark.createDataFrame(pdf).repartition(5)
    got = cumulative.partitioned_running_totals(df, ["g"], "s", ["v"], rows_per_bucket=100).toPandas()
    want = pdf.sort_values("s", ascending=False)
    want["cum"] = want.groupby("g")["v"].cumsum()
    m = got.merge(want, on=["g", "s"])
    assert len(m) == 3000 and (m.cum_v == m.cum).all() and (m.prev_v == m.cum - m.v_x).all()
    assert dict(zip(m.g, m.total_v)) == pdf.groupby("g")["v"].sum().to_dict()


def test_ranges_are_even_and_infinities_have_a_place(spark):
    scores = [float("inf"), float("-inf"), 0.0, 5e-324, *np.exp(np.linspace(-300, 300, 1996)).tolist()]
    df = spark.createDataFrame([(s, 1) for s in scores], "s double, v int").repartition(6)
    splits = cumulative._bucket_splits(df, "s", 10)
    per = np.histogram([s for s in scores if math.isfinite(s)], [-1e308, *splits[1:-1], 1e308])[0]
    assert len(per) >= 8 and max(per) < 500
    got = {r["s"]: r["cum_v"] for r in cumulative.running_totals(df, "s", ["v"], n_buckets=10).collect()}
    assert [got[s] for s in sorted(scores, reverse=True)] == list(range(1, 2001))


def test_area_by_group_does_not_depend_on_ranges(spark, monkeypatch, sf_small):
    df = fx.scored(spark, sf_small).withColumn("g", F.col("application_id") % 2)
    whole = {r["g"]: r["auc"] for r in evaluate.auc_by_group(df, ["g"], "p", "tag").collect()}
    part = cumulative.partitioned_running_totals
    monkeypatch.setattr(cumulative, "partitioned_running_totals", lambda *a, **k: part(*a, **{**k, "rows_per_bucket": 50}))
    cut = {r["g"]: r["auc"] for r in evaluate.auc_by_group(df, ["g"], "p", "tag").collect()}
    assert cut == pytest.approx(whole, abs=1e-12)


def test_noise_is_normal_and_repeats(spark):
    df = spark.range(40_000).withColumn("copy", F.lit(1)).repartition(3)
    z = df.select("id", sampling.md5_normal("1|noise0", "id", "copy").alias("z"), sampling.md5_normal("1|noise1", "id", "copy").alias("y"))
    a = z.toPandas().sort_values("id")
    assert abs(a.z.mean()) < 0.02 and abs(a.z.std() - 1) < 0.02 and abs(np.corrcoef(a.z, a.y)[0, 1]) < 0.02
    assert abs((a.z.abs() > 1.96).mean() - 0.05) < 0.006 and np.isfinite(a.z).all()
    b = z.repartition(1).toPandas().sort_values("id")
    assert (a.z.to_numpy() == b.z.to_numpy()).all()


def test_merges_of_many_columns_equal_single_ones(spark, sf_small):
    mt = fx.modelling_table(spark, sf_small).withColumn("nothing", F.lit(None).cast("double"))
    cols = ["util", "bal", "income", "nothing"]
    many = woe.supervised_merges(mt, cols, "tag", 20, 0.01)
    assert many == {c: woe.supervised_merge(mt, c, "tag", 20, 0.01) for c in cols}
    assert many["nothing"] == [] and many["bal"]
