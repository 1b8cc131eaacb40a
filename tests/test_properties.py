"""Property tests: brute force on small inputs, partition invariance, skew."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from creditspark.operators import evaluate as E
from creditspark.operators import prep, quality, sampling, woe
from creditspark.operators.cumulative import running_totals
from creditspark.sources import fixtures as fx


def test_running_totals_match_single_window(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"s": rng.permutation(5000).astype(float), "v": rng.integers(0, 5, 5000)})
    df = spark.createDataFrame(pdf).repartition(7)
    got = running_totals(df, "s", ["v"], descending=True, n_buckets=16).select("s", "cum_v", "prev_v").toPandas()
    exp = pdf.sort_values("s", ascending=False).assign(cum=lambda x: x.v.cumsum())
    m = got.merge(exp, on="s")
    assert len(m) == 5000
    assert (m.cum_v == m.cum).all()
    assert (m.prev_v == m.cum - m.v).all()


def test_auc_equals_rank_sum(spark, sf_small):
    s = fx.scored(spark, sf_small).select("p", "tag").toPandas()
    ranks = s.p.rank()  # midranks for ties
    n1, n0 = (s.tag == 1).sum(), (s.tag == 0).sum()
    mw = (ranks[s.tag == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)
    auc = E.auc(fx.scored(spark, sf_small), "p", "tag").first()["auc"]
    assert auc == pytest.approx(mw, abs=1e-12)


def test_ks_equals_max_cdf_gap(spark, sf_small):
    s = fx.scored(spark, sf_small).select("p", "tag").toPandas()
    cuts = np.sort(s.p.unique())
    pos, neg = s.p[s.tag == 1].values, s.p[s.tag == 0].values
    ks = max(abs((pos >= c).mean() - (neg >= c).mean()) for c in cuts)
    got = E.ks(E.roc_curve(fx.scored(spark, sf_small), "p", "tag")).first()["ks"]
    assert got == pytest.approx(ks, abs=1e-12)


def test_split_sizes_and_partition_invariance(spark, sf_small):
    mt = fx.modelling_table(spark, sf_small)
    a = sampling.stratified_split(mt.repartition(1), "application_id", "tag", 0.7, 100, prefix_hex=2)
    b = sampling.stratified_split(mt.repartition(9), "application_id", "tag", 0.7, 100, prefix_hex=3)
    ta = {r["application_id"] for r in a.filter("is_train").collect()}
    tb = {r["application_id"] for r in b.filter("is_train").collect()}
    assert ta == tb
    counts = {r["tag"]: r["n"] for r in a.filter("is_train").groupBy("tag").agg(F.count("*").alias("n")).collect()}
    assert counts == {0: round(0.7 * 1253), 1: round(0.7 * 217)}


def test_duplicates_under_skewed_key(spark):
    # one key holds a third of all rows, with exact copies among them
    rows = [(1, i % 5, float(i % 3)) for i in range(300)] + [(k, 0, 1.0) for k in range(2, 602)]
    rows += [(7, 0, 1.0), (7, 0, 1.0)]
    df = spark.createDataFrame(rows, "k long, a int, x double").repartition(5)
    got = sorted(tuple(r) for r in quality.duplicate_occurrences(df, ["k"], ["a", "x"]).collect())
    pdf = pd.DataFrame(rows, columns=["k", "a", "x"]).sort_values(["k", "a", "x"])
    exp = sorted(tuple(r) for r in pdf[pdf.groupby("k").cumcount() > 0].itertuples(index=False))
    assert got == exp
    kept = quality.drop_ambiguous_keys(df, ["k"]).select("k").distinct().count()
    assert kept == 599


def test_caps_idempotent_and_null_safe(spark, sf_small):
    mt = fx.modelling_table(spark, sf_small)
    m = prep.WinsorCapper(upper={"n_trades": 3, "bal": 1e5}).fit(mt)
    once = m.transform(mt)
    twice = m.transform(once)
    assert once.exceptAll(twice).count() == 0
    assert once.filter(F.col("n_trades") > 3).count() == 0
    assert once.filter(F.col("bal").isNull()).count() == mt.filter(F.col("bal").isNull()).count()


def test_zscore_moments(spark, sf_small):
    mt = fx.modelling_table(spark, sf_small)
    z = prep.Standardizer(["income", "price"]).fit(mt).transform(mt, prefix="z_")
    r = z.agg(F.avg("z_income"), F.stddev_samp("z_income"), F.avg("z_price"), F.stddev_samp("z_price")).first()
    assert abs(r[0]) < 1e-9 and abs(r[1] - 1) < 1e-9 and abs(r[2]) < 1e-9 and abs(r[3] - 1) < 1e-9


def test_information_values_non_negative(spark, sf_small):
    mt = fx.modelling_table(spark, sf_small)
    t = woe.info_table(mt, fx.NUMERIC_FEATURES, "tag", k=10)
    assert t.filter(F.col("iv") < -1e-15).count() == 0
    # quantile bins hold NULLs apart and cover every labelled row
    per_var = {r["variable"]: r["n"] for r in t.groupBy("variable").agg(F.sum("n").alias("n")).collect()}
    assert set(per_var.values()) == {1470}


def test_supervised_merge_reduces_bins(spark, sf_small):
    mt = fx.modelling_table(spark, sf_small)
    edges = woe.supervised_merge(mt, "bal", "tag", start_bins=20, stop_limit=0.01)
    assert 1 <= len(edges) <= 19
    assert edges == sorted(edges)


def test_woe_model_applies_to_unseen_rows(spark, sf_small):
    mt = fx.modelling_table(spark, sf_small)
    model = woe.WoeBinner("tag", categorical=["segment", "priority"], numeric=["bal"], k=5).fit(
        mt.filter(F.col("tag").isNotNull()))
    out = model.transform(mt.filter(F.col("tag").isNull()))
    assert out.filter(F.col("woe_priority").isNull() | F.col("woe_bal").isNull()).count() == 0


def test_rose_balances_classes(spark, sf_small):
    mt = fx.modelling_table(spark, sf_small).dropna(subset=["bal"])
    bal = sampling.rose_balance(mt, "application_id", "tag", ["bal", "income"], seed=1)
    shares = {r["tag"]: r["n"] for r in bal.groupBy("tag").agg(F.count("*").alias("n")).collect()}
    total = sum(shares.values())
    assert 0.40 < shares[1] / total < 0.60
    assert 0.85 < total / mt.filter(F.col("tag").isNotNull()).count() < 1.15


def test_cutoff_sweep_matches_brute_force(spark, sf_small):
    s = fx.scored(spark, sf_small)
    grid = E.grid(100, 0.91)
    got = {r["i"]: r for r in E.cutoff_sweep(s, "p", "tag", grid).collect()}
    pdf = s.select("p", "tag").toPandas()
    for i in (0, 17, 50, 99):
        c = grid[i]
        tp = int(((pdf.p >= c) & (pdf.tag == 1)).sum())
        fp = int(((pdf.p >= c) & (pdf.tag == 0)).sum())
        assert (got[i]["tp"], got[i]["fp"]) == (tp, fp)


def test_unpooled_woe_join_path_equals_literal_path(spark, sf_small):
    mt = fx.modelling_table(spark, sf_small)
    lit_model = woe.WoeBinner("tag", categorical=["nation", "priority"], min_share=1e-9).fit(mt)
    join_model = woe.WoeBinner("tag", categorical=["nation", "priority"], min_share=0.0).fit(mt)
    with pytest.raises(ValueError):
        woe.WoeBinner("tag", categorical=["nation"], min_share=0.0, merge_limit=0.1)
    assert set(join_model.lookups) == {"nation", "priority"} and not join_model.categorical
    cols = ["application_id", "woe_nation", "woe_priority"]
    a = lit_model.transform(mt).select(*cols)
    b = join_model.transform(mt).select(*cols)
    assert a.count() == b.count() == 1500
    assert a.exceptAll(b).count() == 0


def test_box_stats_by_group_matches_pandas(spark, sf_small):
    from creditspark.operators import profile
    mt = fx.modelling_table(spark, sf_small).filter(F.col("tag").isNotNull())
    got = {(r["tag"], r["variable"]): r for r in profile.box_stats(mt, ["bal"], by=["tag"]).collect()}
    pdf = mt.select("tag", "bal").toPandas().dropna()
    for t, g in pdf.groupby("tag"):
        q1, q3 = g.bal.quantile(0.25), g.bal.quantile(0.75)
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = g.bal[(g.bal >= lo) & (g.bal <= hi)]
        r = got[(t, "bal")]
        assert r["q1"] == pytest.approx(q1) and r["q3"] == pytest.approx(q3)
        assert r["lower_whisker"] == pytest.approx(inside.min()) and r["upper_whisker"] == pytest.approx(inside.max())
        assert r["n_outliers"] == len(g) - len(inside)


def test_batched_irls_matches_glm(spark, sf_small):
    from creditspark.operators import irls
    from creditspark.operators import models as M
    mt = fx.modelling_table(spark, sf_small).dropna(subset=["bal", "n_trades", "qty"])
    feats = ["bal", "n_trades", "qty", "income"]
    mt = prep.Standardizer(feats).fit(mt).transform(mt)
    design = M.assemble(mt, feats, "tag")
    subsets = [[0, 1], [0, 2, 3], [0, 1, 2, 3]]
    data = irls.array_design(design, "features", "tag")
    fits = irls.batched_logit(data, subsets, irls.gram_matrix(data, max(max(s, default=0) for s in subsets) + 1))
    for s, f in zip(subsets, fits):
        ref = M.fit_logit(mt, [feats[i] for i in s], "tag", tol=1e-10)
        assert f.converged
        assert f.aic == pytest.approx(ref.aic, abs=1e-6)
        assert f.coefficients[0] == pytest.approx(ref.intercept, abs=1e-6)
        assert list(f.coefficients[1:]) == pytest.approx(ref.coefficients, abs=1e-6)
        assert f.std_errors[0] == pytest.approx(ref.std_errors[-1], rel=1e-5)


def test_stepwise_batched_equals_unbatched(spark, sf_small):
    from creditspark.operators import models as M
    mt = fx.modelling_table(spark, sf_small).dropna(subset=["bal", "n_trades", "qty"])
    feats = ["bal", "n_trades", "qty", "income", "price"]
    mt = prep.Standardizer(feats).fit(mt).transform(mt)
    chosen_b, path_b = M.step_aic(mt, feats, "tag", batched=True)
    chosen_u, path_u = M.step_aic(mt, feats, "tag", batched=False)
    assert sorted(chosen_b) == sorted(chosen_u)
    assert [(s, a, t) for s, a, t, _ in path_b] == [(s, a, t) for s, a, t, _ in path_u]
    aics = [a for *_, a in path_b]
    assert all(x >= y for x, y in zip(aics, aics[1:]))


def test_running_totals_bucket_sizing(spark, monkeypatch):
    from creditspark.operators import cumulative
    monkeypatch.setattr(cumulative, "ROWS_PER_BUCKET", 300)
    pdf = pd.DataFrame({"s": np.arange(3000, dtype=float), "v": np.ones(3000, dtype=int)})
    got = cumulative.running_totals(spark.createDataFrame(pdf), "s", ["v"], descending=False).toPandas()
    assert (got.sort_values("s").cum_v.to_numpy() == np.arange(1, 3001)).all()


def test_quantized_curve_bounds_cutoffs(spark, sf_small):
    c = E.roc_curve(fx.scored(spark, sf_small), "p", "tag", quantize=2)
    assert c.count() <= 102
    exact = E.auc(fx.scored(spark, sf_small), "p", "tag").first()["auc"]
    approx = E.auc(fx.scored(spark, sf_small), "p", "tag", quantize=3).first()["auc"]
    assert abs(exact - approx) < 0.01


def test_rose_exact_total(spark, sf_small):
    mt = fx.modelling_table(spark, sf_small).dropna(subset=["bal"])
    n = mt.filter(F.col("tag").isNotNull()).count()
    bal = sampling.rose_balance(mt, "application_id", "tag", ["bal", "income"], seed=1, exact_total=True)
    shares = {r["tag"]: r["n"] for r in bal.groupBy("tag").agg(F.count("*").alias("n")).collect()}
    assert sum(shares.values()) == n
    assert shares == {0: n - n // 2, 1: n // 2} or shares == {0: n // 2 + n % 2, 1: n // 2}


@pytest.mark.parametrize("rows_per_bucket", [10_000_000, 300])
def test_distributed_exact_quantiles_equal_percentile(spark, sf_small, rows_per_bucket):
    from creditspark.operators import profile
    from creditspark.operators.quantiles import grouped_quantiles
    mt = fx.modelling_table(spark, sf_small)
    cols = ["bal", "n_trades", "income", "util"]
    long = profile.long_numeric(mt, cols, ["tag"])
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]
    got = {(r["tag"], r["variable"]): r["q"] for r in
           grouped_quantiles(long, ["tag", "variable"], "value", probs, rows_per_bucket=rows_per_bucket).collect()}
    ref = {(r["tag"], r["variable"]): r["q"] for r in
           long.filter(F.col("value").isNotNull()).groupBy("tag", "variable")
               .agg(F.percentile("value", probs).alias("q")).collect()}
    assert set(got) == set(ref)
    for k in ref:
        assert got[k] == pytest.approx(ref[k], rel=1e-12, abs=1e-12), k


def test_profiles_in_several_rounds_equal_one_round(spark, sf_small):
    from creditspark.operators import profile, quantiles
    mt = fx.modelling_table(spark, sf_small)
    cols = ["bal", "n_trades", "income"]
    old = quantiles.ROWS_PER_BUCKET, quantiles.BUCKETS
    try:
        for fn, kw, key in [(profile.six_number, {"by": ["tag"]}, ("tag", "variable")),
                            (profile.box_stats, {"by": ["tag"]}, ("tag", "variable")),
                            (profile.percentile_profile, {}, ("variable", "pct")),
                            (profile.medians, {}, ("variable",))]:
            quantiles.ROWS_PER_BUCKET, quantiles.BUCKETS = old
            a = {tuple(r[k] for k in key): r.asDict() for r in fn(mt, cols, **kw).collect()}
            quantiles.ROWS_PER_BUCKET, quantiles.BUCKETS = 20, 8
            b = {tuple(r[k] for k in key): r.asDict() for r in fn(mt, cols, **kw).collect()}
            assert a.keys() == b.keys(), fn.__name__
            for k in a:
                for c, v in a[k].items():
                    if isinstance(v, float):
                        assert b[k][c] == pytest.approx(v, rel=1e-12, abs=1e-12), (fn.__name__, k, c)
                    else:
                        assert b[k][c] == v, (fn.__name__, k, c)
        probs = [i / 10 for i in range(1, 10)]
        exact = mt.agg(*[F.percentile(F.col(c).cast("double"), probs).alias(c) for c in cols]).first().asDict()
        cut_e = {c: sorted(set(v)) for c, v in exact.items()}
        cut_d = woe.quantile_cuts(mt, cols, 10)
        assert cut_e.keys() == cut_d.keys()
        for c in cut_e:
            assert cut_d[c] == pytest.approx(cut_e[c], rel=1e-12, abs=1e-12)
    finally:
        quantiles.ROWS_PER_BUCKET, quantiles.BUCKETS = old


def test_percentile_caps(spark, sf_small):
    mt = fx.modelling_table(spark, sf_small)
    m = prep.WinsorCapper(upper_pct=0.9, lower_pct=0.1, cols=["bal", "income"]).fit(mt)
    ref = mt.agg(F.percentile("bal", [0.1, 0.9]).alias("b"), F.percentile("income", [0.1, 0.9]).alias("i")).first()
    assert m.caps["bal"] == pytest.approx(tuple(ref["b"]))
    assert m.caps["income"] == pytest.approx(tuple(ref["i"]))
    out = m.transform(mt).agg(F.max("bal"), F.min("income")).first()
    assert out[0] == pytest.approx(ref["b"][1]) and out[1] == pytest.approx(ref["i"][0])


def test_auc_by_group_equals_single_auc(spark, sf_small, monkeypatch):
    from creditspark.operators import cumulative
    monkeypatch.setattr(cumulative, "ROWS_PER_BUCKET", 100)   # several buckets per group
    s = fx.scored(spark, sf_small)
    two = s.withColumn("grp", F.lit("a")).unionByName(
        s.withColumn("grp", F.lit("b")).withColumn("p", F.lit(1.0) - F.col("p")))
    got = {r["grp"]: r["auc"] for r in E.auc_by_group(two, ["grp"], "p", "tag").collect()}
    ref = E.auc(s, "p", "tag").first()["auc"]
    assert got["a"] == pytest.approx(ref, abs=1e-12)
    assert got["b"] == pytest.approx(1 - ref, abs=1e-12)


def test_curve_monotone(spark, sf_small):
    c = E.roc_curve(fx.scored(spark, sf_small), "p", "tag").toPandas().sort_values("cutoff", ascending=False)
    assert c.tp.is_monotonic_increasing and c.fp.is_monotonic_increasing
    assert c.rpp.is_monotonic_increasing and c.tpr.between(0, 1).all() and c.fpr.between(0, 1).all()
    assert c.iloc[0].tp == 0 and c.iloc[-1].tpr == 1.0 and c.iloc[-1].fpr == 1.0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 1)), min_size=2, max_size=60),
       st.integers(1, 5), st.integers(1, 4))
def test_auc_ks_random_ties_and_partitions(spark, rows, parts, buckets):
    if len({y for _, y in rows}) < 2:
        return
    df = spark.createDataFrame([(float(s), y) for s, y in rows], "p double, tag int").repartition(parts)
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    brute = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert E.auc(df, "p", "tag", n_buckets=buckets).first()["auc"] == pytest.approx(brute, abs=1e-12)
    cuts = sorted({s for s, _ in rows})
    ks = max(sum(a >= c for a in pos) / len(pos) - sum(b >= c for b in neg) / len(neg) for c in cuts)
    got = E.ks(E.roc_curve(df, "p", "tag", n_buckets=buckets)).first()["ks"]
    assert got == pytest.approx(max(ks, 0.0), abs=1e-12)


def test_similar_level_merge(spark, sf_small):
    mt = fx.modelling_table(spark, sf_small)
    counts = {r["level"]: (r["n_good"], r["n_bad"]) for r in
              woe.category_counts(mt, ["nation"], "tag").collect() if r["level"] is not None}
    groups = woe.merge_similar_levels(counts, stop_limit=0.1)
    assert set(groups) == set(counts)
    assert 1 <= len(set(groups.values())) < len(counts)
    for lv, g in groups.items():
        assert lv in g.split("+")
    model = woe.WoeBinner("tag", categorical=["nation"], min_share=0.001, merge_limit=0.1).fit(mt)
    woes = model.categorical["nation"]["levels"]
    for g in set(groups.values()):
        members = g.split("+")
        assert len({round(woes[m], 12) for m in members}) == 1


def test_numeric_merge_key_covers_all_rows(spark, sf_small):
    import __spark_entry__ as entry
    t = entry.queries()["woe_numeric_merge"](spark, sf_small)
    labelled = fx.modelling_table(spark, sf_small).filter(F.col("tag").isNotNull()).count()
    per_var = {r["variable"]: (r["n"], r["k"]) for r in
               t.groupBy("variable").agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect()}
    assert set(per_var) == {"util", "bal"}
    for n, k in per_var.values():
        assert n == labelled and 2 <= k <= 21
