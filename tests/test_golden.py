"""Golden values printed by the reference, and the fixture counts of FIXTURES.md section 4."""

import math

import pytest
from pyspark.sql import functions as F

from creditspark.functions.columns import points_scalar
from creditspark.operators import evaluate as E
from creditspark.operators import scorecard as SC
from creditspark.operators import woe
from creditspark.sources import fixtures as fx


def expand_matrix(spark, tn, fn, fp, tp):
    """Rows (pred, actual) from a 2x2 matrix, generated inside Spark."""
    parts = [(0, 0, tn), (0, 1, fn), (1, 0, fp), (1, 1, tp)]
    dfs = [spark.range(n).select(F.lit(p).alias("pred"), F.lit(a).alias("tag")) for p, a, n in parts]
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


MATRICES = [
    (10943, 416, 9113, 468, .5449, .5456, .5294, .0132),   # RF on application data, cutoff .28
    (12436, 324, 7620, 560, .6206, .6201, .6335, .0513),   # joined LR, cutoff .51
    (12862, 317, 7194, 567, .6413, .6413, .6414, .0599),   # boosted trees, cutoff .195
    (12874, 329, 7182, 555, .6413, .6419, .6278, .0573),   # RF joined, cutoff .17
    (12726, 321, 7330, 563, .6346, .6345, .6369, .0567),   # RF joined, tuned
    (14045, 404, 6014, 905, .6996, .7002, .6914, .1304),   # RF with rejects, cutoff .32
    (13895, 402, 6164, 907, .6927, .6927, .6929, .1261),   # RF with rejects, tuned, cutoff .27
    (14001, 404, 6058, 905, .6976, .6980, .6914, .1290),   # final LR with rejects, cutoff .46
    (45873, 1311, 20980, 1635, .6806, .6862, .5550, None),  # full-table final LR, cutoff .46
]


@pytest.mark.parametrize("tn,fn,fp,tp,acc,sens,spec,kappa", MATRICES)
def test_confusion_matrix_metrics(spark, tn, fn, fp, tp, acc, sens, spec, kappa):
    r = E.confusion(expand_matrix(spark, tn, fn, fp, tp), "pred", "tag").first()
    assert (r["tn"], r["fn"], r["fp"], r["tp"]) == (tn, fn, fp, tp)
    assert r["accuracy"] == pytest.approx(acc, abs=6e-5)
    assert r["sensitivity"] == pytest.approx(sens, abs=6e-5)
    assert r["specificity"] == pytest.approx(spec, abs=6e-5)
    if kappa is not None:
        assert r["kappa"] == pytest.approx(kappa, abs=6e-5)


def test_financials_reproduce_reference(spark):
    # p is set so that p >= .46 <=> predicted default
    df = expand_matrix(spark, 45873, 1311, 20980, 1635).withColumn(
        "p", F.when(F.col("pred") == 1, F.lit(0.9)).otherwise(F.lit(0.1)))
    r = SC.financials(df, "p", "tag", 0.46).first()
    assert r["profit_without"] == 39_665_000
    assert r["profit_with"] == 156_865_000
    assert r["net_gain"] == 117_200_000
    assert r["pct_gain"] == pytest.approx(295.4746, abs=1e-4)
    assert r["revenue_loss_pct"] == pytest.approx(31.3823, abs=1e-4)
    assert r["credit_loss_without_pct"] == pytest.approx(4.2207, abs=1e-4)
    assert r["credit_loss_with_pct"] == pytest.approx(1.8783, abs=1e-4)
    assert r["credit_loss_saved_pct"] == pytest.approx(2.3424, abs=1e-4)


def test_cutoff_score():
    assert points_scalar(0.46) == pytest.approx(338.1879, abs=1e-4)
    assert 20 / (math.log(20) - math.log(10)) == pytest.approx(28.8539, abs=1e-4)


def test_bin_table_contract(spark):
    # bin sizes of the reference's dependents table; Percent = N / total and a zero-cell bin has WOE 0, IV 0
    rows = [("d", -1, 3, 3, 0), ("d", 0, 45989, 44000, 1989), ("d", 1, 23872, 22916, 956)]
    t = woe.add_woe_iv(spark.createDataFrame(rows, "variable string, bin_id int, n long, n_good long, n_bad long"))
    got = {r["bin_id"]: r for r in t.collect()}
    total = 3 + 45989 + 23872
    for b, n in ((-1, 3), (0, 45989), (1, 23872)):
        assert got[b]["pct"] == pytest.approx(n / total, rel=1e-12)
    assert got[-1]["woe"] == 0.0 and got[-1]["iv"] == 0.0
    g, bb = 44000 + 22916 + 3, 1989 + 956
    w0 = math.log((44000 / g) / (1989 / bb))
    assert got[0]["woe"] == pytest.approx(w0, rel=1e-12)
    assert got[0]["iv"] == pytest.approx((44000 / g - 1989 / bb) * w0, rel=1e-12)


def test_fixture_counts_sf0001(spark, sf_small):
    mt = fx.modelling_table(spark, sf_small)
    assert mt.count() == 1500
    tags = {r["tag"]: r["count"] for r in mt.groupBy("tag").count().collect()}
    assert tags == {0: 1253, 1: 217, None: 30}
    assert mt.filter(F.col("n_trades").isNull()).count() == 27
    assert mt.filter(F.col("priority").isNull()).count() == 297
    assert mt.filter(F.col("income") < 0).count() == 106


def test_fixed_scorer_ks_auc_sf0001(spark, sf_small):
    s = fx.scored(spark, sf_small)
    ks = E.ks(E.roc_curve(s, "p", "tag")).first()["ks"]
    auc = E.auc(s, "p", "tag").first()["auc"]
    assert ks == pytest.approx(0.526962, abs=1e-6)
    assert auc == pytest.approx(0.820288, abs=1e-6)
    assert fx.scored(spark, sf_small, labelled_only=False).filter(F.col("p") >= 0.46).count() == 423


def test_csv_two_null_spellings_and_header_with_space(spark):
    from creditspark.session import scratch_path
    from creditspark.sources import io
    path = scratch_path(spark, "csv-in")
    rows = ["Application ID,No.of.dependents,Gender", "1,3,M", "2,NA,F", "3,,NA", '4,5,""']
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.text(path)
    df = io.sanitize_names(io.read_csv(spark, path))
    assert df.columns == ["application_id", "no_of_dependents", "gender"]
    got = {r["application_id"]: (r["no_of_dependents"], r["gender"]) for r in df.collect()}
    assert got == {1: (3, "M"), 2: (None, "F"), 3: (None, None), 4: (5, None)}


@pytest.mark.parametrize("tn,fn,fp,tp,acc,sens,spec,k", [m for m in MATRICES if m[-1] is not None])
def test_python_kappa_matches_spark_kappa(tn, fn, fp, tp, acc, sens, spec, k):
    from creditspark.operators.models import kappa
    assert kappa(tn, fn, fp, tp) == pytest.approx(k, abs=6e-5)
