"""AG keys: distribution summaries over the applicant table."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditspark.operators import profile as P
from creditspark.plans.catalog import r6, register
from creditspark.plans.oracle_base import CATEGORICAL, NUMERIC, unpivot_sql, with_fixture
from creditspark.plans.queries_prep import BAL_BREAKS, UTIL_BREAKS, _case_sql
from creditspark.sources import fixtures as fx

CUTOFF_P = 0.46


def _mt(spark, d):
    return fx.modelling_table(spark, d)


def _lab(spark, d):
    return _mt(spark, d).filter(F.col("tag").isNotNull())


def _u(source, cols=NUMERIC, extra="tag"):
    return f"u AS ({unpivot_sql(source, cols, 'double', extra=extra)})"


@register("class_counts", with_fixture("select tag, count(*) n from mt group by tag"))
def class_counts(spark, d):
    """AG1: table(tag) with the NULL class."""
    return P.class_counts(_mt(spark, d), "tag")


@register("class_shares", with_fixture(
    "select tag, n, round(cast(n as double) / sum(n) over (), 6) share "
    "from (select tag, count(*) n from mt group by tag) s"))
def class_shares(spark, d):
    """AG2: prop.table(table(tag))."""
    return P.class_shares(_mt(spark, d), "tag").select("tag", "n", r6("share"))


@register("six_number", with_fixture(
    """select variable, count(*) n, round(min(value), 6) min, round(quantile_cont(value, 0.25), 6) q1,
              round(quantile_cont(value, 0.5), 6) median, round(avg(value), 6) mean,
              round(quantile_cont(value, 0.75), 6) q3, round(max(value), 6) max
       from u where value is not null group by variable""", _u("lab")))
def six_number(spark, d):
    """AG3: summary(): min, quartiles, median, mean, max per numeric variable in one pass."""
    t = P.six_number(_lab(spark, d), NUMERIC)
    return t.select("variable", "n", *[r6(c) for c in ["min", "q1", "median", "mean", "q3", "max"]])


@register("median_by_column", with_fixture(
    "select variable, round(quantile_cont(value, 0.5), 6) median from u group by variable", _u("mt")))
def median_by_column(spark, d):
    """AG4: median(x, na.rm = TRUE) per column."""
    return P.medians(_mt(spark, d), NUMERIC).select("variable", r6("median"))


@register("percentile_profile", with_fixture(
    """select q.variable, cast(r.i as integer) pct, round(q.qs[r.i + 1], 6) value
       from (select variable, quantile_cont(value, [""" + ", ".join(repr(i / 100) for i in range(101)) + """]) qs
             from u group by variable) q cross join range(0, 101) r(i)""", _u("lab")))
def percentile_profile(spark, d):
    """AG5: quantile(x, seq(0, 1, 0.01)) per variable (the input to cap selection)."""
    return P.percentile_profile(_lab(spark, d), NUMERIC).select("variable", "pct", r6("value"))


def _box_sql(by: str):
    byc = f"{by}, " if by else ""
    on = f"u.{by} = q.{by} and " if by else ""
    return with_fixture(
        f"""select {byc.replace(by, 'q.' + by) if by else ''}q.variable, s.n, round(q1, 6) q1, round(median, 6) median,
                   round(q3, 6) q3, round(q3 - q1, 6) iqr, round(lw, 6) lower_whisker, round(uw, 6) upper_whisker,
                   s.n_outliers
            from q join (
              select {('u.' + by + ', ') if by else ''}u.variable, count(*) n,
                     min(case when value >= q1 - 1.5 * (q3 - q1) and value <= q3 + 1.5 * (q3 - q1) then value end) lw,
                     max(case when value >= q1 - 1.5 * (q3 - q1) and value <= q3 + 1.5 * (q3 - q1) then value end) uw,
                     cast(sum(case when value >= q1 - 1.5 * (q3 - q1) and value <= q3 + 1.5 * (q3 - q1)
                                   then 0 else 1 end) as bigint) n_outliers
              from u join q on {on}u.variable = q.variable
              where value is not null group by {('u.' + by + ', ') if by else ''}u.variable) s
            on {('s.' + by + ' = q.' + by + ' and ') if by else ''}s.variable = q.variable""",
        _u("lab"),
        f"""q AS (select {byc}variable, quantile_cont(value, 0.25) q1, quantile_cont(value, 0.5) median,
                         quantile_cont(value, 0.75) q3 from u where value is not null group by {byc}variable)""")


def _box_out(t, by=()):
    return t.select(*by, "variable", "n", r6("q1"), r6("median"), r6("q3"), r6("iqr"),
                    r6("lower_whisker"), r6("upper_whisker"), "n_outliers")


@register("box_stats", _box_sql(""))
def box_stats(spark, d):
    """AG6: boxplot statistics: quartiles, 1.5*IQR whiskers, outlier count."""
    return _box_out(P.box_stats(_lab(spark, d), NUMERIC))


@register("box_stats_by_class", _box_sql("tag"))
def box_stats_by_class(spark, d):
    """AG7: boxplot statistics per class of the tag."""
    return _box_out(P.box_stats(_lab(spark, d), NUMERIC, by=["tag"]), by=["tag"])


@register("bar_counts", with_fixture(
    "select variable, level value, count(*) n from (" + unpivot_sql("mt", CATEGORICAL, "varchar",
                                                                   value_name="level") + ") s group by variable, level"))
def bar_counts(spark, d):
    """AG8: bar heights per categorical level, NULL kept."""
    return P.bar_counts(_mt(spark, d), CATEGORICAL)


@register("stacked_counts", with_fixture(
    "select variable, level value, tag, count(*) n from (" + unpivot_sql("mt", CATEGORICAL, "varchar",
                                                                        value_name="level")
    + ") s group by variable, level, tag"))
def stacked_counts(spark, d):
    """AG9: stacked bar counts per (level, class)."""
    return P.stacked_counts(_mt(spark, d), CATEGORICAL, "tag")


def _default_rate_sql():
    u = unpivot_sql("lab", CATEGORICAL, "varchar", value_name="level")
    u += (f"\n union all select 'util', cast({_case_sql('util', UTIL_BREAKS, list(range(1, len(UTIL_BREAKS))))}"
          f" as varchar), tag from lab")
    u += (f"\n union all select 'bal', cast({_case_sql('bal', BAL_BREAKS, list(range(1, len(BAL_BREAKS))))}"
          f" as varchar), tag from lab")
    return with_fixture(
        f"""select variable, level value, count(*) n, cast(sum(tag) as bigint) n_bad,
                   round(avg(cast(tag as double)), 6) default_rate
            from ({u}) s group by variable, level""")


@register("default_rate", _default_rate_sql())
def default_rate(spark, d):
    """AG10: default rate per category and per cut() bin of util and bal, all in one pass."""
    t = P.default_rate(_lab(spark, d), CATEGORICAL, "tag", {"util": UTIL_BREAKS, "bal": BAL_BREAKS})
    return t.select("variable", "value", "n", "n_bad", r6("default_rate"))


@register("histogram", with_fixture(
    """select g.bin, round(mn + g.bin * (mx - mn) / 30, 6) lo, round(mn + (g.bin + 1) * (mx - mn) / 30, 6) hi,
              coalesce(c.n, 0) n
       from (select cast(range as integer) bin from range(0, 30)) g
       cross join mm
       left join (select least(cast(floor((bal - mn) / (mx - mn) * 30) as integer), 29) bin, count(*) n
                  from mt cross join mm where bal is not null group by 1) c on c.bin = g.bin""",
    "mm AS (select min(bal) mn, max(bal) mx from mt)"))
def histogram(spark, d):
    """AG11: 30 equal-width bins of the balance, empty bins included."""
    t = P.histogram(_mt(spark, d), "bal", 30)
    return t.select("bin", r6("lo"), r6("hi"), "n")


def _corr_sql():
    pairs = [(a, b) for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1:]]
    return with_fixture("\n union all ".join(
        f"select '{a}' var_x, '{b}' var_y, round(corr(cast({a} as double), cast({b} as double)), 6) corr from lab"
        for a, b in pairs))


@register("corr_matrix", _corr_sql())
def corr_matrix(spark, d):
    """AG12: Pearson correlation of every numeric pair (columns found from the schema, FL5), long form,
    one aggregate pass."""
    lab = _lab(spark, d)
    cols = P.numeric_columns(lab, exclude=["application_id", "tag", "nation"])
    return P.corr_long(lab, cols).select("var_x", "var_y", r6("corr"))


@register("count_above_below", with_fixture(
    f"""select count(*) filter (where p > {CUTOFF_P}) n_above, count(*) filter (where p < {CUTOFF_P}) n_below,
               count(*) filter (where p = {CUTOFF_P}) n_equal from scored_all"""))
def count_above_below(spark, d):
    """AG13: strict counts above and below a threshold."""
    return P.count_above_below(fx.scored(spark, d, labelled_only=False), "p", CUTOFF_P)


@register("distinct_levels", with_fixture(
    "select distinct priority level from mt where priority is not null"))
def distinct_levels(spark, d):
    """AG14: levels(factor(priority))."""
    return P.distinct_levels(_mt(spark, d), "priority")
