"""DQ keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditspark.operators import quality as q
from creditspark.plans.catalog import r6, register
from creditspark.plans.oracle_base import with_fixture
from creditspark.sources import fixtures as fx

LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LI_KEY = ["l_orderkey", "l_linenumber"]
LI_ORDER = [c for c in LI_COLS if c not in LI_KEY]
LI_SEL = ", ".join(LI_COLS)
LI_OUT = ", ".join([*LI_COLS[:-1], "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as l_shipdate"])


def _li(spark, d):
    return fx.table(spark, d, "lineitem").select(*LI_COLS)


def _shown(df):
    return df.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))


@register("distinct_keys", with_fixture(
    """select 'lineitem' table_name, cast(sum(n) as bigint) n_rows, count(*) n_distinct_keys
       from (select l_orderkey, l_linenumber, count(*) n from lineitem group by l_orderkey, l_linenumber) s
       union all
       select 'applications', cast(sum(n) as bigint), count(*)
       from (select application_id, count(*) n from app group by application_id) s"""))
def distinct_keys(spark, d):
    """DQ1: distinct key count per table (composite key on line items)."""
    a = q.distinct_keys(_li(spark, d), LI_KEY).select(F.lit("lineitem").alias("table_name"), "*")
    b = q.distinct_keys(fx.applications(spark, d), ["application_id"]) \
        .select(F.lit("applications").alias("table_name"), "*")
    return a.unionByName(b)


@register("dup_rows", with_fixture(
    f"""select {LI_OUT} from (
          select *, row_number() over (partition by l_orderkey, l_linenumber
                                       order by {', '.join(LI_ORDER)}) rn
          from (select {LI_SEL} from lineitem) s) t where rn > 1"""))
def dup_rows(spark, d):
    """DQ2: second and later occurrences of each (order, line number) key."""
    return _shown(q.duplicate_occurrences(_li(spark, d), LI_KEY, LI_ORDER))


@register("drop_ambiguous_keys", with_fixture(
    f"""select {LI_OUT} from lineitem l where not exists (
          select 1 from (select l_orderkey k1, l_linenumber k2 from lineitem
                         group by l_orderkey, l_linenumber having count(*) > 1) x
          where x.k1 = l.l_orderkey and x.k2 = l.l_linenumber)"""))
def drop_ambiguous_keys(spark, d):
    """DQ3: remove every row of a key that occurs more than once."""
    return _shown(q.drop_ambiguous_keys(_li(spark, d), LI_KEY))


def _nulls_sql(table, cols):
    return " + ".join(f"count(*) - count({c})" for c in cols)


@register("null_cells", with_fixture(
    f"""select 'applications' table_name, cast({_nulls_sql('app', fx.APP_COLUMNS)} as bigint) n_null_cells from app
        union all
        select 'bureau', cast({_nulls_sql('bureau', fx.BUREAU_COLUMNS)} as bigint) from bureau"""))
def null_cells(spark, d):
    """DQ4: total NULL cells per table."""
    a = q.null_cells(fx.applications(spark, d)).select(F.lit("applications").alias("table_name"), "*")
    b = q.null_cells(fx.bureau(spark, d)).select(F.lit("bureau").alias("table_name"), "*")
    return a.unionByName(b)


def _null_by_col_sql():
    parts = [f"select 'applications' table_name, '{c}' column_name, count(*) - count({c}) n_null from app"
             for c in fx.APP_COLUMNS]
    parts += [f"select 'bureau', '{c}', count(*) - count({c}) from bureau" for c in fx.BUREAU_COLUMNS]
    return with_fixture("\n union all ".join(parts))


@register("null_by_column", _null_by_col_sql())
def null_by_column(spark, d):
    """DQ5: NULL count per column, one aggregate pass per table."""
    a = q.null_by_column(fx.applications(spark, d)).select(F.lit("applications").alias("table_name"), "*")
    b = q.null_by_column(fx.bureau(spark, d)).select(F.lit("bureau").alias("table_name"), "*")
    return a.unionByName(b)


@register("target_null_rate", with_fixture(
    """select count(*) n_rows, count(*) - count(tag) n_null,
              round(cast(count(*) - count(tag) as double) / cast(count(*) as double), 6) null_rate
       from bureau"""))
def target_null_rate(spark, d):
    """DQ6: share of applications without a performance tag."""
    return q.target_null_rate(fx.bureau(spark, d), "tag").select("n_rows", "n_null", r6("null_rate"))


@register("split_labelled", with_fixture(
    """select application_id, case when tag is null then 'unlabelled' else 'labelled' end population
       from mt"""))
def split_labelled(spark, d):
    """DQ7: labelled / unlabelled populations as a column."""
    return q.with_population(fx.modelling_table(spark, d), "tag").select("application_id", "population")


_ALL_LI = LI_SEL + ", l_shipdate"


@register("full_row_dups", with_fixture(
    f"""select cast(sum(c) as bigint) n_rows, count(*) n_distinct_rows, cast(sum(c - 1) as bigint) n_full_dups
        from (select {_ALL_LI}, count(*) c from lineitem group by {_ALL_LI}) s"""))
def full_row_dups(spark, d):
    """DQ8: fully duplicated line-item rows."""
    return q.full_row_dups(fx.table(spark, d, "lineitem"))


@register("key_setdiff", with_fixture(
    """select key, 'a_not_b' direction from (select o_orderkey key from orders
                                              except select l_orderkey from lineitem) s
       union all
       select key, 'b_not_a' from (select l_orderkey key from lineitem except select o_orderkey from orders) s"""))
def key_setdiff(spark, d):
    """DQ9: order keys without line items and line-item keys without orders."""
    return q.key_setdiff(fx.table(spark, d, "orders"), fx.table(spark, d, "lineitem"),
                         "o_orderkey", "l_orderkey").select("key", "direction")


@register("range_reject", with_fixture(
    """select application_id, income, case when income < 0 then 'rejected' else 'kept' end status from app"""))
def range_reject(spark, d):
    """DQ10: invalid-range rows (income < 0) as a side output; NULL values are kept."""
    return q.range_reject(fx.applications(spark, d), F.col("income") < 0).select(
        "application_id", "income", "status")
