"""Applicant tables built from the driver's TPC-H-style parquet tables.

These builders only reshape the test tables into the schema the credit
operators expect (FIXTURES.md section 2): an order is an application, its
customer supplies demographics, its line items supply bureau-style features.
They do none of the operators' work.

Application side  : application_id, tenure_days, income, price, segment,
                    priority (one level mapped to NULL), nation
Bureau side       : application_id, n_trades, qty, util, bal, tag
                    (tag NULL = rejected applicant, 1 = default, 0 = good)
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture definition (FIXTURES.md section 2).
TENURE_ORIGIN = _dt.date(1995, 1, 1)
NULL_PRIORITY = "4-NOT SPECIFIED"
REJECT_MODULUS = 50
REJECT_REMAINDER = 7
DEFAULT_MIN_RETURNS = 3

APP_COLUMNS = ["application_id", "tenure_days", "income", "price", "segment", "priority", "nation"]
BUREAU_COLUMNS = ["application_id", "n_trades", "qty", "util", "bal", "tag"]
NUMERIC_FEATURES = ["tenure_days", "income", "price", "n_trades", "qty", "util", "bal"]
CATEGORICAL_FEATURES = ["segment", "priority", "nation"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")


def _customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")


def _app_projection():
    return [
        F.col("o_orderkey").alias("application_id"),
        F.datediff(F.to_date("o_orderdate"), F.lit(TENURE_ORIGIN)).cast("long").alias("tenure_days"),
        F.col("c_acctbal").alias("income"),
        F.col("o_totalprice").alias("price"),
        F.col("c_mktsegment").alias("segment"),
        F.when(F.col("o_orderpriority") == NULL_PRIORITY, F.lit(None).cast("string"))
         .otherwise(F.col("o_orderpriority")).alias("priority"),
        F.col("c_nationkey").alias("nation"),
    ]


def line_item_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order aggregates of line items (partial aggregation map-side)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_discount", "l_extendedprice", "l_returnflag")
    return li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_trades"),
        F.sum("l_quantity").alias("qty"),
        F.round(F.avg("l_discount"), 6).alias("util"),
        F.round(F.sum("l_extendedprice"), 2).alias("bal"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("n_ret"),
    )


def _tag():
    return (F.when(F.col("o_orderkey") % REJECT_MODULUS == REJECT_REMAINDER, F.lit(None).cast("int"))
             .when(F.coalesce(F.col("n_ret"), F.lit(0)) >= DEFAULT_MIN_RETURNS, F.lit(1))
             .otherwise(F.lit(0)).alias("tag"))


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Application (demographic) table: orders joined to their customer."""
    o, c = _orders(spark, sf_dir), _customers(spark, sf_dir)
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select(*_app_projection())


def bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bureau table: one row per order; orders without line items get NULLs."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    li = line_item_features(spark, sf_dir)
    return o.join(li, o.o_orderkey == li.l_orderkey, "left").select(
        F.col("o_orderkey").alias("application_id"),
        "n_trades", "qty", "util", "bal", _tag())


def modelling_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Application and bureau columns for every application, from one orders scan.

    Same rows as ``applications ⋈ bureau`` on application_id (both sides are
    keyed by the order key), without scanning orders twice.
    """
    o, c = _orders(spark, sf_dir), _customers(spark, sf_dir)
    li = line_item_features(spark, sf_dir)
    joined = (o.join(c, o.o_custkey == c.c_custkey, "inner")
               .join(li, o.o_orderkey == li.l_orderkey, "left"))
    return joined.select(*_app_projection(), "n_trades", "qty", "util", "bal", _tag())


# Fixed scorer of FIXTURES.md section 3 (coefficients are fixture constants).
FIXED_SCORER_COEF = {"bal": 0.000004, "n_trades": 0.25}
FIXED_SCORER_INTERCEPT = -2.5


def fixed_scorer(col_bal="bal", col_trades="n_trades"):
    """p = round(1 / (1 + exp(-(0.000004*bal + 0.25*n_trades - 2.5))), 10)."""
    lin = (F.lit(FIXED_SCORER_COEF["bal"]) * F.col(col_bal)
           + F.lit(FIXED_SCORER_COEF["n_trades"]) * F.col(col_trades)
           + F.lit(FIXED_SCORER_INTERCEPT))
    return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-lin)), 10)


def scored(spark: SparkSession, sf_dir: str, labelled_only: bool = True) -> DataFrame:
    """Modelling rows with a fixed-scorer probability ``p`` (rows with bal present)."""
    mt = modelling_table(spark, sf_dir).filter(F.col("bal").isNotNull())
    if labelled_only:
        mt = mt.filter(F.col("tag").isNotNull())
    return mt.withColumn("p", fixed_scorer())
