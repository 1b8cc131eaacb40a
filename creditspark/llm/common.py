"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditspark.operators.cache import small  # noqa: F401 - the modules here take it from this one
from creditspark.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the lineage, and what a
    lost executor had computed stays readable."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(col: Column) -> Column:
    """Only A-Z become lower case."""
    return F.translate(col, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """``body(v)`` with ``value`` evaluated once per row.

    A lambda variable cannot be inlined by the optimizer, unlike an alias, whose expression would
    be run again for every element of a higher-order function that mentions it.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of undirected edges: one row (node, label) per node with an edge.

    Alternating large-star and small-star steps: every step is one grouped aggregate and one join on
    the node, no node's neighbours meet in one task as a list, and each step's links are written
    to the shared folder.  The label is the least node of the component.
    """
    spark = edges.sparkSession
    e = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
               .filter(F.col("u") > F.col("v")).distinct(), "links")
    nxt = e
    while not e.isEmpty():
        # large star: neighbours above a node move to the least of its closed neighbourhood
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: a node and its lower neighbours move to the least of these
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).filter(F.col("u") > F.col("v"))
        nxt = stored(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        # stars only: no node is both a centre and a leaf, and no leaf has two centres
        n = nxt.agg(F.count(F.lit(1)), F.count_distinct("u")).first()
        if n[0] == n[1] and nxt.join(nxt.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            break
        e = nxt
    return nxt.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        nxt.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
