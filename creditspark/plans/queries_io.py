"""IO keys: table profile, CSV round trip and rejects, snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditspark.functions.columns import cap
from creditspark.operators import quality
from creditspark.plans.catalog import register
from creditspark.plans.oracle_base import with_fixture
from creditspark.session import scratch_path
from creditspark.sources import fixtures as fx
from creditspark.sources import io


@register("table_profile", with_fixture(
    """select 'applications' table_name, count(*) n_rows, 7 n_cols from app
       union all select 'bureau', count(*), 6 from bureau
       union all select 'modelling', count(*), 12 from mt"""))
def table_profile(spark, d):
    """IO3: rows and columns of the applicant tables."""
    return io.table_profile({"applications": fx.applications(spark, d), "bureau": fx.bureau(spark, d),
                             "modelling": fx.modelling_table(spark, d)})


@register("csv_roundtrip", with_fixture("select * from app"))
def csv_roundtrip(spark, d):
    """IO1+IO2: write the application table as CSV (NULL as "NA") to the shared folder, read it back."""
    app = fx.applications(spark, d)
    path = scratch_path(spark, "applications-csv")
    io.write_csv(app, path)
    return io.read_csv(spark, path, schema=app.schema)


_LINE = """case when application_id % 97 = 5 then application_id || ',x1,' || {seg}
               when application_id % 101 = 7 then application_id || ',2'
               when application_id % 103 = 9 then application_id || ',3,' || {seg} || ',more'
               when application_id % 107 = 11 then application_id || ',NA,'
               else application_id || ',' || tenure_days || ',' || {seg} end"""


@register("csv_rejects", with_fixture(
    f"""select case when bad then 'rejected' else 'good' end kind, case when bad then null else application_id end application_id,
               case when bad or application_id % 107 = 11 then null else tenure_days end tenure_days,
               case when bad or application_id % 107 = 11 then null else segment end segment,
               case when bad then {_LINE.format(seg='segment')} end record
        from (select *, application_id % 97 = 5 or application_id % 101 = 7 or application_id % 103 = 9 bad from app)"""))
def csv_rejects(spark, d):
    """IO1: a CSV with wrong types, missing and surplus fields is read into good rows and rejected lines."""
    app = fx.applications(spark, d)
    path = scratch_path(spark, "rejects-csv")
    app.select(F.expr(_LINE.format(seg="segment")).alias("value")).write.text(path)
    schema = T.StructType([T.StructField("application_id", T.LongType()), T.StructField("tenure_days", T.LongType()), T.StructField("segment", T.StringType())])
    good, rejected = io.read_csv_with_rejects(spark, path, schema, header=False)
    return good.select(F.lit("good").alias("kind"), *schema.names, F.lit(None).cast("string").alias("record")).unionByName(
        rejected.select(F.lit("rejected").alias("kind"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], "record"))


# fixed values of the changes that the snapshot is compared with
BAL_CAP, UTIL_FLOOR = 200000.0, 0.05
CHANGED = {"bal": f"case when bal > {BAL_CAP} then {BAL_CAP} else bal end", "n_trades": "coalesce(n_trades, 0)",
           "util": f"case when util < {UTIL_FLOOR} then null else util end", "income": "income"}


@register("snapshot_changes", with_fixture(" union all ".join(
    f"""select '{c}' variable, count(*) filter ({c} is distinct from x) n_changed, count(*) filter ({c} is null and x is not null) n_filled,
               count(*) filter ({c} is not null and x is null) n_emptied from (select {c}, {e} x from mt)""" for c, e in CHANGED.items())))
def snapshot_changes(spark, d):
    """IO4: a snapshot of the modelling table taken before three columns are changed, and what the changes did."""
    kept = io.Snapshots(spark)
    before = kept.take("modelling", fx.modelling_table(spark, d))
    after = (before.withColumn("bal", cap("bal", BAL_CAP)).withColumn("n_trades", F.coalesce("n_trades", F.lit(0).cast("long")))
             .withColumn("util", F.when(F.col("util") < UTIL_FLOOR, F.lit(None)).otherwise(F.col("util"))))
    return quality.changed_cells(kept.read("modelling"), after, "application_id", list(CHANGED))
