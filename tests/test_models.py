"""Model keys cannot be oracle-checked in SQL: assert quality bands and structure instead."""

import pytest
from pyspark.sql import functions as F

from creditspark.operators import evaluate as E
from creditspark.operators import models as M
from creditspark.plans.modelling import build_design
from creditspark.sources import fixtures as fx

SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def design(spark):
    return build_design(fx.modelling_table(spark, SF_MID))


def _auc(pred, col="p"):
    return E.auc(pred, col, "tag").first()["auc"]


def test_logistic_model_band(spark, design):
    fit = M.fit_logit(design.balanced, design.features, "tag")
    auc = _auc(design.test.withColumn("p", fit.probability()))
    assert 0.75 < auc < 0.95
    t = fit.table(spark).collect()
    assert t[0]["term"] == "(Intercept)" and len(t) == len(design.features) + 1


def test_forest_and_boosting_bands(spark, design):
    train, test = design.vectors("balanced"), design.vectors("test")
    rf = M.random_forest(train, "tag", num_trees=30, mtry=5)
    p_rf = rf.transform(test).withColumn("p", M.positive_probability(rf.transform(test)))
    gbt = M.boosted_trees(design.vectors("train"), "tag", rounds=20)
    p_gbt = gbt.transform(test).withColumn("p", M.positive_probability(gbt.transform(test)))
    assert 0.7 < _auc(p_rf) < 0.95
    assert 0.7 < _auc(p_gbt) < 0.95
    imp = M.importance_table(spark, rf, design.features).collect()
    assert sum(r["importance"] for r in imp) == pytest.approx(1.0)
    assert [r["rank"] for r in imp] == list(range(1, len(design.features) + 1))


def test_svm_predictions_beat_chance(spark, design):
    svm = M.linear_svm(design.vectors("balanced"), "tag")
    pred = svm.transform(design.vectors("test")).withColumn("pred", F.col("prediction").cast("int"))
    c = E.confusion(pred, "pred", "tag").first()
    assert c["kappa"] > 0.1
    assert c["tn"] + c["fn"] + c["fp"] + c["tp"] == design.test.count()


def test_vif_finite_and_at_least_one(spark, design):
    fit = M.fit_logit(design.balanced, design.features, "tag")
    v = dict(M.vif(design.balanced, fit))
    assert set(v) == set(design.features)
    assert all(x is not None and x >= 1.0 - 1e-9 for x in v.values())


def test_auc_per_round_matches_truncated_model(spark, design):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    train, test = design.vectors("train"), design.vectors("test")
    m = M.boosted_trees(train, "tag", rounds=8)
    per_round = M.auc_per_round(m, test, "tag", digits=12)
    assert sorted(per_round) == list(range(1, 9))
    full = BinaryClassificationEvaluator(labelCol="tag", rawPredictionCol="rawPrediction").evaluate(m.transform(test))
    assert per_round[8] == pytest.approx(full, abs=1e-9)
    m3 = M.boosted_trees(train, "tag", rounds=3)
    auc3 = BinaryClassificationEvaluator(labelCol="tag", rawPredictionCol="rawPrediction").evaluate(m3.transform(test))
    assert per_round[3] == pytest.approx(auc3, abs=1e-9)


def test_auc_per_round_does_not_tie_close_margins(spark):
    class Tree:
        def copy(self):
            return self

        def setPredictionCol(self, name):
            self.name = name
            return self

        def transform(self, df):
            return df.withColumn(self.name, F.col("features") * 1e-6)

    class Model:
        trees, treeWeights = [Tree()], [1.0]

    valid = spark.createDataFrame([(float(i), int(i >= 5)) for i in range(10)], "features double, tag int")
    assert M.auc_per_round(Model(), valid, "tag") == {1: 1.0}
