"""A streaming run of the scorer gives the same rows as the batch run."""

from pyspark.sql import functions as F

from creditspark.operators.scorecard import cutoff_score
from creditspark.session import scratch_path
from creditspark.sources import fixtures as fx
from creditspark.streaming import scoring


def test_stream_scoring_equals_batch(spark, sf_small):
    apps = fx.modelling_table(spark, sf_small)
    src = scratch_path(spark, "stream-src")
    apps.repartition(4).write.parquet(src)          # four files arrive as micro-batches
    cut = cutoff_score(0.46)

    stream = scoring.read_stream(spark, src, apps.schema, max_files_per_trigger=1)
    out = scratch_path(spark, "stream-out")
    q = scoring.write_stream(scoring.score_applications(stream, fx.fixed_scorer(), cut), out)
    q.awaitTermination(300)
    assert q.exception() is None

    got = spark.read.parquet(out)
    batch = scoring.score_applications(apps, fx.fixed_scorer(), cut)
    assert got.count() == batch.count() == 1500
    assert got.exceptAll(batch).count() == 0
    decisions = {r["decision"] for r in got.select("decision").distinct().collect()}
    assert decisions <= {"approve", "decline", "unscored"}
    assert got.filter(F.col("decision") == "unscored").count() == apps.filter(F.col("bal").isNull()).count()
