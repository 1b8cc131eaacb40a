"""PR, FL, SO, JN and ST keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditspark.functions import columns as C
from creditspark.operators import prep
from creditspark.operators.ordering import ranked
from creditspark.plans.catalog import r6, register
from creditspark.plans.oracle_base import with_fixture
from creditspark.sources import fixtures as fx

# Fixed parameters of the registered queries.
UTIL_BREAKS = [round(i * 0.01, 2) for i in range(11)]            # cut(util, seq(0, .1, .01))
BAL_BREAKS = [float(i * 100000) for i in range(9)]                # cut(bal, seq(0, 8e5, 1e5))
RECODE_RULES = [(1.0, 3.0, -0.005), (4.0, float("inf"), 0.01)]    # the dependents recode
CAPS_UPPER = {"n_trades": 8, "qty": 300.0, "bal": 500000.0}
CAPS_LOWER = {"income": 0.0}
Z_COLS = ["tenure_days", "income", "price", "bal"]


def _mt(spark, d):
    return fx.modelling_table(spark, d)


def _case_sql(col, breaks, values):
    parts = []
    for i in range(1, len(breaks)):
        lo, hi = breaks[i - 1], breaks[i]
        left = f"{col} >= {lo!r}" if i == 1 else f"{col} > {lo!r}"
        parts.append(f"when {left} and {col} <= {hi!r} then {values[i - 1]}")
    return "case " + " ".join(parts) + " end"


@register("conditional_flag", with_fixture(
    "select application_id, tag, case when tag is null then null when tag = 0 then 1 else 0 end reverse_tag from mt"))
def conditional_flag(spark, d):
    """PR1: reverse tag with NULL propagated (ifelse semantics)."""
    return _mt(spark, d).select("application_id", "tag", C.reverse_tag("tag").cast("int").alias("reverse_tag"))


@register("column_subset", with_fixture("select application_id, segment, priority, bal from mt"))
def column_subset(spark, d):
    """PR2: keep a named column subset (pruned down to the parquet scan)."""
    keep = {"application_id", "segment", "priority", "bal"}
    mt = _mt(spark, d)
    return mt.select(*[c for c in mt.columns if c in keep])


@register("recast", with_fixture(
    """select application_id, cast(tag as varchar) tag_str, cast(n_trades as double) n_trades_d,
              cast(tenure_days as integer) tenure_i, cast(nation as varchar) nation_s from mt"""))
def recast(spark, d):
    """PR6: factor/character/numeric recasts."""
    return _mt(spark, d).select(
        "application_id", F.col("tag").cast("string").alias("tag_str"),
        F.col("n_trades").cast("double").alias("n_trades_d"),
        F.col("tenure_days").cast("int").alias("tenure_i"), F.col("nation").cast("string").alias("nation_s"))


@register("round_half_even", with_fixture(
    """select application_id, qty / 2 half, round_even(qty / 2, 0) half_even, round(qty / 2, 0) half_up
       from mt where qty is not null"""))
def round_half_even(spark, d):
    """PR8: R round() is half-to-even (bround); round() in Spark is half-up."""
    x = F.col("qty") / 2
    return _mt(spark, d).filter(F.col("qty").isNotNull()).select(
        "application_id", x.alias("half"), F.bround(x, 0).alias("half_even"), F.round(x, 0).alias("half_up"))


@register("null_impute", with_fixture(
    """select application_id, coalesce(n_trades, 0) n_trades, coalesce(qty, 0) qty,
              coalesce(util, 0) util, coalesce(bal, 0) bal from mt"""))
def null_impute(spark, d):
    """PR9: NULL imputation by a constant."""
    return _mt(spark, d).select("application_id", *[F.coalesce(F.col(c), F.lit(0)).alias(c)
                                                    for c in ["n_trades", "qty", "util", "bal"]])


def _recode_sql(x):
    return (f"case when {x} is null then 0.0::double when {x} >= 1.0 and {x} <= 3.0 then -0.005::double "
            f"when {x} >= 4.0 then 0.01::double when {x} < 1.0 then 0.0::double else cast({x} as double) end")


@register("range_recode", with_fixture(
    f"""select application_id, {_recode_sql('n_trades')} n_trades_recoded,
               {_recode_sql('util * 100')} util_recoded from mt"""))
def range_recode(spark, d):
    """PR10: loop recode NULL/0 -> 0, [1,3] -> -0.005, >=4 -> 0.01, gaps unchanged, as one CASE."""
    return _mt(spark, d).select(
        "application_id",
        C.range_recode("n_trades", RECODE_RULES, 0.0, 0.0).alias("n_trades_recoded"),
        C.range_recode(F.col("util") * 100, RECODE_RULES, 0.0, 0.0).alias("util_recoded"))


def _label_sql(col, breaks):
    labels = C.cut_labels(breaks)
    return _case_sql(col, breaks, [f"'{s}'" for s in labels])


@register("cut_bins", with_fixture(
    f"""select application_id, {_case_sql('util', UTIL_BREAKS, list(range(1, len(UTIL_BREAKS))))} util_bin,
               {_label_sql('util', UTIL_BREAKS)} util_label,
               {_case_sql('bal', BAL_BREAKS, list(range(1, len(BAL_BREAKS))))} bal_bin from mt"""))
def cut_bins(spark, d):
    """PR11: fixed-break right-closed intervals, lowest closed, outside -> NULL."""
    return _mt(spark, d).select(
        "application_id", C.cut_index("util", UTIL_BREAKS).alias("util_bin"),
        C.cut_label("util", UTIL_BREAKS).alias("util_label"), C.cut_index("bal", BAL_BREAKS).alias("bal_bin"))


@register("winsor_cap", with_fixture(
    """select application_id, case when n_trades > 8 then 8 else n_trades end n_trades,
              case when qty > 300.0 then 300.0 else qty end qty,
              case when income < 0.0 then 0.0 else income end income,
              case when bal > 500000.0 then 500000.0 else bal end bal from mt"""))
def winsor_cap(spark, d):
    """PR12: caps/floors at constants; NULL values untouched."""
    model = prep.WinsorCapper(upper=CAPS_UPPER, lower=CAPS_LOWER).fit(_mt(spark, d))
    return model.transform(_mt(spark, d)).select("application_id", "n_trades", "qty", "income", "bal")


@register("zscore", with_fixture(
    "select application_id, " + ", ".join(
        f"round((cast({c} as double) - avg(cast({c} as double)) over ()) / stddev_samp(cast({c} as double)) over (), 6) z_{c}"
        for c in Z_COLS) + " from mt"))
def zscore(spark, d):
    """PR13: z-scores with the sample sd, fitted once, applied as a projection."""
    mt = _mt(spark, d)
    model = prep.Standardizer(Z_COLS).fit(mt)
    return model.transform(mt, prefix="z_").select("application_id", *[r6(f"z_{c}") for c in Z_COLS])


@register("log_odds", with_fixture(
    "select application_id, round(p, 6) p, round(ln((1 - p) / p), 6) log_odds from scored_all"))
def log_odds(spark, d):
    """PR14: ln((1 - p) / p) of the fixed scorer."""
    s = fx.scored(spark, d, labelled_only=False)
    return s.select("application_id", r6("p"), r6(C.log_odds_good("p"), "log_odds"))


@register("filter_null_safe", with_fixture("select application_id, bal from mt where bal > 100000"))
def filter_null_safe(spark, d):
    """FL1: predicate filter; a NULL predicate drops the row (pushed to the scan where possible)."""
    return _mt(spark, d).filter(F.col("bal") > 100000).select("application_id", "bal")


@register("reject_rows", with_fixture("select application_id, true is_reject from mt where tag is null"))
def reject_rows(spark, d):
    """FL3: the reject block selected by a flag carried through the union, not by row position."""
    mt = _mt(spark, d)
    u = prep.union_populations(mt.filter(F.col("tag").isNotNull()), mt.filter(F.col("tag").isNull()))
    return u.filter(F.col("is_reject")).select("application_id", "is_reject")


@register("ranked_applications", with_fixture(
    "select application_id, bal, row_number() over (order by bal desc nulls last, application_id) as rank from mt"))
def ranked_applications(spark, d):
    """SO1: every application's place in a descending order with a tiebreak, which shows the order itself."""
    return ranked(_mt(spark, d).select("application_id", "bal"), [F.col("bal").desc_nulls_last(), F.col("application_id")])


@register("top_n", with_fixture(
    "select application_id, bal from mt where bal is not null order by bal desc, application_id limit 6"))
def top_n(spark, d):
    """SO2: head() of a descending sort: distributed top-k (TakeOrderedAndProject)."""
    return _mt(spark, d).filter(F.col("bal").isNotNull()) \
        .orderBy(F.col("bal").desc(), F.col("application_id")).limit(6).select("application_id", "bal")


@register("inner_join", with_fixture("select * from mt"))
def inner_join(spark, d):
    """JN1: application ⋈ bureau on the key; AQE picks broadcast or sort-merge at runtime."""
    a, b = fx.applications(spark, d), fx.bureau(spark, d)
    return a.join(b, "application_id", "inner")


@register("anti_join", with_fixture(
    """select application_id, segment from app
       where application_id not in (select application_id from bureau where tag is null)"""))
def anti_join(spark, d):
    """JN2: keep applications whose key is not in the reject key set (left anti join)."""
    rejects = fx.bureau(spark, d).filter(F.col("tag").isNull()).select("application_id")
    return fx.applications(spark, d).join(rejects, "application_id", "left_anti").select("application_id", "segment")


@register("union_by_name", with_fixture("select application_id, tag, segment from mt"))
def union_by_name(spark, d):
    """ST1: union by column name of differently ordered projections."""
    mt = _mt(spark, d)
    a = mt.filter(F.col("tag").isNotNull()).select("application_id", "tag", "segment")
    b = mt.filter(F.col("tag").isNull()).select("segment", "application_id", "tag")
    return a.unionByName(b)


@register("set_difference", with_fixture(
    "select c_custkey key from customer except select o_custkey from orders"))
def set_difference(spark, d):
    """ST2: EXCEPT DISTINCT: customers that never applied."""
    c = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("key"))
    o = fx.table(spark, d, "orders").select(F.col("o_custkey").alias("key"))
    return c.subtract(o)
