"""WO keys: WOE tables, information tables, IV summary and ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditspark.operators import woe
from creditspark.plans import ranking
from creditspark.plans.catalog import r6, register
from creditspark.plans.oracle_base import (CATEGORICAL, NUMERIC, categorical_woe_ctes, info_table_ctes, woe_cols_sql,
                                           monotone_ctes, with_fixture)
from creditspark.sources import fixtures as fx

MIN_SHARE = 0.03          # pooling threshold used by the registered queries
NULL_BEARING = ["n_trades", "qty", "util", "bal"]
BIN_COLS = ["variable", "bin_id", "min_value", "max_value", "n", "n_good", "n_bad"]


def _mt(spark, d):
    return fx.modelling_table(spark, d)


def _bins_out(t):
    return t.select(*BIN_COLS, r6("pct"), r6("woe"), r6("iv"), r6("iv_cum"))


_BINS_SQL = ("select variable, bin_id, min_value, max_value, n, n_good, n_bad, round(pct, 6) pct, "
             "round(woe, 6) woe, round(iv, 6) iv, round(iv_cum, 6) iv_cum from {t}")


@register("woe_categorical", with_fixture(
    "select variable, level, n, n_good, n_bad, round(pct, 6) pct, round(woe, 6) woe, round(iv, 6) iv from cw",
    *categorical_woe_ctes("cw", CATEGORICAL, MIN_SHARE)))
def woe_categorical(spark, d):
    """WO1: categorical WOE with NULL as its own level and small levels pooled into 'misc'."""
    t = woe.woe_categorical(_mt(spark, d), CATEGORICAL, "tag", min_share=MIN_SHARE)
    return t.select("variable", "level", "n", "n_good", "n_bad", r6("pct"), r6("woe"), r6("iv"))


@register("info_table_k2", with_fixture(_BINS_SQL.format(t="it"), *info_table_ctes("it", NUMERIC, 2)))
def info_table_k2(spark, d):
    """WO4: two quantile bins per numeric variable (median cut), NULL bin, cumulative IV."""
    return _bins_out(woe.info_table(_mt(spark, d), NUMERIC, "tag", k=2))


@register("info_table_k10", with_fixture(_BINS_SQL.format(t="it"), *info_table_ctes("it", NUMERIC, 10)))
def info_table_k10(spark, d):
    """WO5: default ten quantile bins per numeric variable."""
    return _bins_out(woe.info_table(_mt(spark, d), NUMERIC, "tag", k=10))


_IV_BINS_SQL = with_fixture(
    """select variable, bin_id, n, round(pct, 6) pct, round(woe, 6) woe, round(iv, 6) iv,
              round(sum(iv) over (partition by variable order by bin_id
                                  rows between unbounded preceding and current row), 6) iv_cum
       from (select variable, bin_id, n, pct, woe, iv from it
             union all
             select variable,
                    case when level is null then -1
                         else cast(row_number() over (partition by variable, level is null order by level) - 1
                                   as integer) end bin_id,
                    n, pct, woe, iv from cw) s""",
    *info_table_ctes("it", NUMERIC, 10), *categorical_woe_ctes("cw", CATEGORICAL, MIN_SHARE))


@register("iv_bins", _IV_BINS_SQL)
def iv_bins(spark, d):
    """WO6: per-bin N, Percent, WOE and cumulative IV for numeric and categorical variables."""
    from pyspark.sql import Window
    mt = _mt(spark, d)
    num = woe.info_table(mt, NUMERIC, "tag", k=10).select("variable", "bin_id", "n", "pct", "woe", "iv")
    cat = woe.woe_categorical(mt, CATEGORICAL, "tag", MIN_SHARE)
    wl = Window.partitionBy("variable", F.col("level").isNull()).orderBy("level")
    cat = cat.select("variable", F.when(F.col("level").isNull(), F.lit(-1))
                     .otherwise(F.row_number().over(wl) - 1).cast("int").alias("bin_id"),
                     "n", "pct", "woe", "iv")
    allb = num.unionByName(cat)
    w = Window.partitionBy("variable").orderBy("bin_id").rowsBetween(Window.unboundedPreceding, 0)
    return allb.select("variable", "bin_id", "n", r6("pct"), r6("woe"), r6("iv"),
                       r6(F.sum("iv").over(w), "iv_cum"))


@register("iv_summary", with_fixture(
    """select variable, round(sum(iv), 6) iv from (select variable, iv from it union all
       select variable, iv from cw) s group by variable""",
    *info_table_ctes("it", NUMERIC, 10), *categorical_woe_ctes("cw", CATEGORICAL, MIN_SHARE)))
def iv_summary(spark, d):
    """WO7: information value per variable (ten quantile bins / pooled categories)."""
    mt = _mt(spark, d)
    num = woe.info_table(mt, NUMERIC, "tag", k=10).select("variable", "iv")
    cat = woe.woe_categorical(mt, CATEGORICAL, "tag", MIN_SHARE).select("variable", "iv")
    return woe.iv_summary(num.unionByName(cat)).select("variable", r6("iv"))


_RANK_SQL = with_fixture(
    """select cast(row_number() over (order by iv desc, variable) as integer) rank,
              variable, kind, n_bins, round(iv, 6) iv
       from (select f.variable, 'fine' kind, cast(count(*) as integer) n_bins, sum(f.iv) iv
             from fine f join mono m on f.variable = m.variable where m.is_monotone group by f.variable
             union all
             select c.variable, 'coarse', cast(count(*) as integer), sum(c.iv)
             from coarse c join mono m on c.variable = m.variable where not m.is_monotone group by c.variable
             union all
             select variable, 'categorical', cast(count(*) as integer), sum(iv) from cw group by variable) s""",
    *info_table_ctes("fine", NUMERIC, 10), *monotone_ctes("mono", "fine"),
    *info_table_ctes("coarse", NUMERIC, 3), *categorical_woe_ctes("cw", CATEGORICAL, MIN_SHARE))


def _ranking(spark, d):
    t = ranking.iv_ranking(_mt(spark, d), NUMERIC, CATEGORICAL, "tag", min_share=MIN_SHARE)
    return t.select("rank", "variable", "kind", "n_bins", r6("iv"))


@register("iv_ranking", _RANK_SQL)
def iv_ranking(spark, d):
    """WO8: fine bins for monotone variables, coarse bins otherwise, plus categoricals, ranked by IV."""
    return _ranking(spark, d)


@register("sort_desc", _RANK_SQL)
def sort_desc(spark, d):
    """SO1: the IV list sorted descending by value with a name tiebreak (explicit rank column)."""
    return _ranking(spark, d).orderBy(F.col("iv").desc(), F.col("variable"))


@register("woe_monotone", with_fixture(
    """select m.variable, m.is_monotone monotone_k10,
              case when m.is_monotone then 10 else 3 end chosen_bins from mono m""",
    *info_table_ctes("fine", NUMERIC, 10), *monotone_ctes("mono", "fine")))
def woe_monotone(spark, d):
    """WO9: monotone-WOE check on ten bins; non-monotone variables fall back to three bins."""
    _, flags, _ = ranking.fine_and_coarse_bins(_mt(spark, d), NUMERIC, "tag")
    return flags.select("variable", F.col("is_monotone").alias("monotone_k10"),
                        F.when(F.col("is_monotone"), 10).otherwise(3).alias("chosen_bins"))


APPLY_BODY = """select m.application_id,
              round(case when m.segment is null then coalesce(sn.woe, 0.0::double) else coalesce(s.woe, sm.woe, 0.0::double) end, 6) woe_segment,
              round(case when m.priority is null then coalesce(pn.woe, 0.0::double) else coalesce(p.woe, pm.woe, 0.0::double) end, 6) woe_priority,
              round(case when m.nation is null then coalesce(nn.woe, 0.0::double) else coalesce(n.woe, nm.woe, 0.0::double) end, 6) woe_nation
       from mt m
       left join cw s on s.variable = 'segment' and s.level = m.segment
       left join cw sn on sn.variable = 'segment' and sn.level is null
       left join cw sm on sm.variable = 'segment' and sm.level = 'misc'
       left join cw p on p.variable = 'priority' and p.level = m.priority
       left join cw pn on pn.variable = 'priority' and pn.level is null
       left join cw pm on pm.variable = 'priority' and pm.level = 'misc'
       left join cw n on n.variable = 'nation' and n.level = cast(m.nation as varchar)
       left join cw nn on nn.variable = 'nation' and nn.level is null
       left join cw nm on nm.variable = 'nation' and nm.level = 'misc'"""
APPLY_CTES = categorical_woe_ctes("cw", CATEGORICAL, MIN_SHARE)
_APPLY_SQL = with_fixture(APPLY_BODY, *APPLY_CTES)


@register("woe_apply", _APPLY_SQL)
def woe_apply(spark, d):
    """WO3: fitted categorical bins applied to every applicant, labelled or not."""
    mt = _mt(spark, d)
    model = woe.WoeBinner("tag", categorical=CATEGORICAL, min_share=MIN_SHARE).fit(mt)
    out = model.transform(mt)
    return out.select("application_id", r6("woe_segment"), r6("woe_priority"), r6("woe_nation"))


def _replace_body():
    sel = ", ".join(f"round(coalesce(j{i}.woe, 0.0::double), 6) {c}" for i, c in enumerate(NULL_BEARING))
    frm = "from mt m " + " ".join(
        f"join (select cuts from it_q where variable = '{c}') q{i} on true "
        f"left join it j{i} on j{i}.variable = '{c}' and j{i}.bin_id = "
        f"(case when m.{c} is null then -1 else cast(len(list_filter(q{i}.cuts, lambda e: e < m.{c})) "
        f"as integer) end)"
        for i, c in enumerate(NULL_BEARING))
    return f"select m.application_id, {sel} {frm}"


REPLACE_BODY = _replace_body()
REPLACE_CTES = info_table_ctes("it", NULL_BEARING, 10)


def _replace_sql():
    return with_fixture(REPLACE_BODY, *REPLACE_CTES)


@register("woe_replace", _replace_sql())
def woe_replace(spark, d):
    """WO10: NULL-bearing numeric columns replaced by their fitted ten-bin WOE value."""
    mt = _mt(spark, d)
    model = woe.WoeBinner("tag", numeric=NULL_BEARING, k=10).fit(mt)
    return model.transform(mt, replace=True).select("application_id", *[r6(c) for c in NULL_BEARING])


def _merge_sql(cols, k, limit):
    """Adjacent bins merged by closest WOE while a step loses ix most ``limit`` of the IV, as lists in a recursion."""
    woe = lambda g, b: f"case when {g} = 0 or {b} = 0 then 0.0 else ln(({g} / gt) / ({b} / bt)) end"
    iv = lambda g, b: (f"list_sum(list_transform(range(1, len({g}) + 1), lambda i: ({g}[i] / gt - {b}[i] / bt) * "
                       + woe(f"{g}[i]", f"{b}[i]") + "))")
    merged = lambda x: f"list_concat({x}[1:ix - 1], [{x}[ix] + {x}[ix + 1]], {x}[ix + 2:])"
    ctes = [c.replace("list_distinct(quantile_cont(x,", "list_sort(list_distinct(quantile_cont(x,").replace("])) cuts", "]))) cuts")
            for c in info_table_ctes("it", cols, k)]
    return with_fixture(
        f"select variable, {', '.join(c for c in BIN_COLS if c != 'variable')}, round(pct, 6) pct, round(woe, 6) woe, round(iv, 6) iv, round(iv_cum, 6) iv_cum from fin",
        *ctes,
        """first AS (select c.variable, list(n_good::double order by bin_id) as g, list(n_bad::double order by bin_id) as b,
                            list(cuts[bin_id + 1] order by bin_id) as e, sum(n_good)::double as gt, sum(n_bad)::double as bt
                     from it_c c join it_q q on q.variable = c.variable where bin_id >= 0 group by c.variable)""",
        f"""steps AS (select variable, 0 as step, g, b, e[1:len(g) - 1] as e, gt, bt from first
           union all
           select variable, step, g2, b2, e2, gt, bt from (
             select variable, step + 1 as step, {merged('g')} as g2, {merged('b')} as b2, list_concat(e[1:ix - 1], e[ix + 1:]) as e2, gt, bt, cur from (
               select *, list_position(gaps, list_min(gaps)) as ix from (
                 select *, {iv('g', 'b')} as cur,
                        list_transform(range(1, len(g)), lambda i: abs({woe('g[i]', 'b[i]')} - {woe('g[i + 1]', 'b[i + 1]')})) as gaps
                 from steps where len(g) > 1) x1) x2) x3
           where (case when cur > 0 then (cur - {iv('g2', 'b2')}) / cur else 0 end) <= {limit})""",
        "cut AS (select variable, arg_max(e, step) as cuts from steps group by variable)",
        """f_b AS (select u.variable, case when x is null then -1 else cast(len(list_filter(q.cuts, lambda c: c < x)) as integer) end bin_id, x, tag
                  from it_u u join cut q on u.variable = q.variable)""",
        """f_c AS (select variable, bin_id, min(x) min_value, max(x) max_value, count(*) n,
                  cast(sum(case when tag = 0 then 1 else 0 end) as bigint) n_good, cast(sum(case when tag = 1 then 1 else 0 end) as bigint) n_bad
                  from f_b group by variable, bin_id)""",
        f"f_w AS ({woe_cols_sql('f_c')})",
        "fin AS (select *, sum(iv) over (partition by variable order by bin_id rows between unbounded preceding and current row) iv_cum from f_w)",
    ).replace("WITH", "WITH RECURSIVE", 1)


@register("woe_numeric_merge", _merge_sql(["util", "bal"], 20, 0.01))
def woe_numeric_merge(spark, d):
    """WO2: supervised merge of twenty quantile bins with IV-loss stop limit 0.01, then the merged table."""
    mt = _mt(spark, d)
    lab = mt.filter(F.col("tag").isNotNull())
    edges = woe.supervised_merges(lab, ["util", "bal"], "tag", start_bins=20, stop_limit=0.01)
    return woe.info_table(lab, list(edges), "tag", cuts=edges).select(
        *BIN_COLS, r6("pct"), r6("woe"), r6("iv"), r6("iv_cum"))
