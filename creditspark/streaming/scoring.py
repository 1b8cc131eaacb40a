"""Scoring applications as they arrive, with Structured Streaming.

The reference is batch-only; what carries over to a stream is the part of
its flow that is a stateless projection once fitted: WOE encoding (WO3),
scaling (PR13), the logistic probability (ML6), the points score (SC1) and
the approve / decline decision at a cutoff score (SC4).  No state store, no
watermark is needed because no step aggregates across rows.

Sink: files (parquet) with a checkpoint location under the session's shared
checkpoint folder, so a restarted query resumes exactly where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from creditspark.functions.columns import points
from creditspark.session import scratch_path


def score_applications(stream: DataFrame, probability: Column, cutoff_score: float,
                       encode: Callable[[DataFrame], DataFrame] | None = None,
                       key: str = "application_id") -> DataFrame:
    """(key, p, score, decision) for each incoming row; works on batch and streaming DataFrames."""
    df = encode(stream) if encode is not None else stream
    scored = df.withColumn("p", probability).withColumn("score", points("p"))
    decision = (F.when(F.col("score").isNull(), F.lit("unscored"))
                 .when(F.col("score") > F.lit(cutoff_score), F.lit("approve"))
                 .otherwise(F.lit("decline")))
    return scored.select(key, "p", "score", decision.alias("decision"))


def read_stream(spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int = 64) -> DataFrame:
    """Parquet folder as a streaming source (explicit schema, bounded files per micro-batch)."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))


def write_stream(df: DataFrame, out_path: str, checkpoint: str | None = None,
                 available_now: bool = True) -> StreamingQuery:
    """Append scored rows to parquet; exactly-once through the checkpointed file sink."""
    spark = df.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "stream-ckpt")
    w = df.writeStream.format("parquet").outputMode("append").option("path", out_path) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
