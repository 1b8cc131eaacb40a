"""Ranks without a one-task window, named snapshots, broadcasts checked by rows and bytes."""

import random
import warnings

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from creditspark.operators import cache, models, quality
from creditspark.operators.ordering import ranked
from creditspark.plans import catalog
from creditspark.sources.io import Snapshots

from tests.conftest import SF_SMALL


def test_ranks_equal_a_sorted_list(spark):
    r = random.Random(1)
    rows = [(i, r.choice([None, 1.0, 2.0, float("inf"), float("nan"), r.random()]) if i % 3 else 7.0) for i in range(3000)]  # a third tie
    df = spark.createDataFrame(rows, "id long, x double").repartition(7)
    got = {x["id"]: x["place"] for x in ranked(df, [F.col("x").desc_nulls_last(), F.col("id")], "place").collect()}
    key = lambda p: (p[1] is None, 0 if p[1] is None else -1e400 if p[1] != p[1] else -p[1])  # noqa: E731 - NaN above all, as Spark has it
    nan = [p for p in rows if p[1] is not None and p[1] != p[1]]
    rest = [p for p in rows if not (p[1] is not None and p[1] != p[1])]
    want = sorted(nan) + sorted(rest, key=lambda p: (*key(p), p[0]))
    assert [got[p[0]] for p in want] == list(range(1, 3001))


def test_ranks_of_ties_and_of_nothing(spark):
    same = spark.createDataFrame([(1,)] * 50, "x int").repartition(5)
    assert sorted(x["rank"] for x in ranked(same, [F.col("x")]).collect()) == list(range(1, 51))
    assert ranked(same.filter("x > 1"), [F.col("x")]).collect() == []


def test_rank_plan_moves_no_table_to_one_task(spark):
    plan = ranked(spark.range(1000), [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("SinglePartition") <= 1  # the offsets alone


def test_rank_query_keeps_its_order(spark):
    catalog.load_all()
    got = catalog.QUERIES["ranked_applications"](spark, SF_SMALL).collect()
    got.sort(key=lambda x: x["rank"])
    assert [x["rank"] for x in got] == list(range(1, len(got) + 1))
    assert got == sorted(got, key=lambda x: (x["bal"] is None, -(x["bal"] or 0), x["application_id"]))


def test_snapshot_outlives_its_source(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a"), (2, None)], "id int, v string").write.parquet(path)
    kept = Snapshots(spark)
    before = kept.take("t", spark.read.parquet(path))
    spark.createDataFrame([(1, "b"), (2, "c"), (3, None)], "id int, v string").write.mode("overwrite").parquet(path)
    after = spark.read.parquet(path)
    assert [tuple(x) for x in quality.changed_cells(before, after, "id", ["v"]).collect()] == [("v", 2, 1, 0)]
    assert kept.names() == ["t"] and sorted(map(tuple, kept.read("t").collect())) == [(1, "a"), (2, None)]
    kept.take("t", after)
    assert kept.read("t").count() == 3
    gone = kept._kept["t"][0]
    kept.release("t")
    kept.release("never taken")
    assert kept.names() == []
    with pytest.raises(KeyError):
        kept.read("t")
    with pytest.raises(AnalysisException):
        spark.read.parquet(gone)


@pytest.mark.parametrize("rows, kind, most_bytes, fits", [
    ([(1, "x" * 1000)], "a int, b string", 2000, True), ([(1, "x" * 1000)], "a int, b string", 900, False),
    ([(1, ["x" * 100] * 10)], "a int, b array<string>", 900, False), ([(1, ["x" * 100] * 10)], "a int, b array<string>", 3000, True),
    ([(1, None)], "a int, `b.c` string", 100, True), ([], "a int, b map<string,int>", 0, True), ([(1, bytearray(500))], "a int, b binary", 400, False)])
def test_broadcasts_are_checked_by_bytes(spark, rows, kind, most_bytes, fits):
    df = spark.createDataFrame(rows, kind)
    hinted = "broadcast" in cache.small(df, 10, most_bytes)._jdf.queryExecution().logical().toString().lower()
    assert hinted == fits
    assert "broadcast" not in cache.small(spark.range(11), 10)._jdf.queryExecution().logical().toString().lower()


def test_unfinished_fits_are_reported(spark):
    r = random.Random(3)
    df = spark.createDataFrame([(x := r.gauss(0, 1), int(x + r.gauss(0, 1) > 0)) for _ in range(300)], "x double, y int")
    with pytest.warns(UserWarning, match="logistic fit"):
        models.fit_logit(df, ["x"], "y", max_iter=1)
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        models.fit_logit(df, ["x"], "y")
        models.linear_svm(models.assemble(df, ["x"], "y"), "y")
    with pytest.warns(UserWarning, match="linear SVM"):
        models.linear_svm(models.assemble(df, ["x"], "y"), "y", max_iter=1)
