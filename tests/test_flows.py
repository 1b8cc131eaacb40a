"""The three end-to-end flows run on the smallest tables and satisfy basic identities."""

import pytest
from pyspark.sql import functions as F

from creditspark.plans import flows


@pytest.fixture(scope="module")
def b(spark, sf_small):
    return flows.path_b(spark, sf_small)


def test_path_a(spark, sf_small):
    a = flows.path_a(spark, sf_small)
    rank = a["iv_ranking"].orderBy("rank").collect()
    assert [r["rank"] for r in rank] == list(range(1, 11))
    assert all(r["iv"] >= 0 for r in rank)
    back = spark.read.option("header", "true").csv(a["csv_path"].first()["path"])
    assert back.count() == 10


def test_path_b(b):
    ks = b["ks"].first()["ks"]
    auc = b["auc"].first()["auc"]
    assert 0 < ks < 1 and 0.5 < auc <= 1
    aics = [r["aic"] for r in b["step_path"].orderBy("step").collect()]
    assert all(x >= y for x, y in zip(aics, aics[1:]))
    c = b["confusion"].first()
    assert c["tn"] + c["fn"] + c["fp"] + c["tp"] == b["design"].test.count()
    assert 0 < b["cutoff"] < 1


def test_path_c(spark, sf_small, b):
    c = flows.path_c(spark, sf_small, b)
    n_rej = sum(r["count"] for r in c["inferred_counts"].collect())
    assert n_rej == 30
    f = c["financials"].first()
    assert f["net_gain"] == pytest.approx(f["profit_with"] - f["profit_without"])
    assert f["credit_loss_saved_pct"] == pytest.approx(f["credit_loss_without_pct"] - f["credit_loss_with_pct"])
    ad = c["approve_decline"].first()
    assert ad["n_above"] + ad["n_below"] <= 1500
    assert c["score_by_population"].filter(F.col("population") == "rejected").first()["n"] == 30
