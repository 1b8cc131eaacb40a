"""Shared DuckDB SQL pieces for the oracle strings (fixture views and generators).

The driver pre-registers the raw tables as views; these CTEs rebuild the
applicant tables exactly like ``creditspark.sources.fixtures`` does.
"""

from __future__ import annotations

FIXTURE_CTES = """
app AS (
  select o_orderkey application_id,
         cast(date_diff('day', date '1995-01-01', cast(o_orderdate as date)) as bigint) tenure_days,
         c_acctbal income, o_totalprice price, c_mktsegment segment,
         case when o_orderpriority = '4-NOT SPECIFIED' then null else o_orderpriority end priority,
         c_nationkey nation
  from orders join customer on o_custkey = c_custkey),
li AS (
  select l_orderkey, count(*) n_trades, sum(l_quantity) qty,
         round(avg(l_discount), 6) util, round(sum(l_extendedprice), 2) bal,
         sum(case when l_returnflag = 'R' then 1 else 0 end) n_ret
  from lineitem group by l_orderkey),
bureau AS (
  select o_orderkey application_id, n_trades, qty, util, bal,
         case when o_orderkey % 50 = 7 then null
              when coalesce(n_ret, 0) >= 3 then 1 else 0 end tag
  from orders left join li on l_orderkey = o_orderkey),
mt AS (
  select a.application_id, a.tenure_days, a.income, a.price, a.segment, a.priority, a.nation,
         b.n_trades, b.qty, b.util, b.bal, b.tag
  from app a join bureau b on a.application_id = b.application_id),
lab AS (select * from mt where tag is not null),
scored_all AS (
  select *, round(1 / (1 + exp(-(0.000004*bal + 0.25*n_trades - 2.5))), 10) p
  from mt where bal is not null),
scored AS (select * from scored_all where tag is not null)"""

NUMERIC = ["tenure_days", "income", "price", "n_trades", "qty", "util", "bal"]
CATEGORICAL = ["segment", "priority", "nation"]


def with_fixture(body: str, *ctes: str) -> str:
    """Prefix ``body`` with the fixture CTEs plus extra ``name AS (...)`` CTEs."""
    extra = "".join(",\n" + c for c in ctes)
    return "WITH" + FIXTURE_CTES + extra + "\n" + body


def unpivot_sql(source: str, cols: list[str], value_type: str, extra: str = "tag",
                value_name: str = "value") -> str:
    parts = [f"select '{c}' variable, cast({c} as {value_type}) {value_name}, {extra} from {source}"
             for c in cols]
    return "\n  union all ".join(parts)


def woe_cols_sql(src: str) -> str:
    """Select list adding pct/woe/iv to a (variable, ..., n, n_good, n_bad) CTE ``src``."""
    return f"""
  select t.*, cast(n as double) / NT pct,
         case when n_good = 0 or n_bad = 0 then 0.0::double
              else ln((cast(n_good as double) / GT) / (cast(n_bad as double) / BT)) end woe,
         (cast(n_good as double) / GT - cast(n_bad as double) / BT)
           * (case when n_good = 0 or n_bad = 0 then 0.0::double
                   else ln((cast(n_good as double) / GT) / (cast(n_bad as double) / BT)) end) iv
  from (select *, sum(n) over (partition by variable) NT,
               sum(n_good) over (partition by variable) GT,
               sum(n_bad) over (partition by variable) BT from {src}) t"""


def categorical_woe_ctes(name: str, cols: list[str], min_share: float, source: str = "lab") -> list[str]:
    """CTEs ending in ``{name}`` = (variable, level, n, n_good, n_bad, pct, woe, iv, NT, GT, BT)."""
    u = unpivot_sql(source, cols, "varchar", value_name="level")
    return [
        f"{name}_u AS ({u})",
        f"""{name}_c0 AS (select variable, level, count(*) n,
               sum(case when tag = 0 then 1 else 0 end) n_good,
               sum(case when tag = 1 then 1 else 0 end) n_bad
        from {name}_u group by variable, level)""",
        f"""{name}_c1 AS (select variable,
               case when level is not null
                     and cast(n as double) / sum(n) over (partition by variable) < {min_share!r}
                    then 'misc' else level end level, n, n_good, n_bad
        from {name}_c0)""",
        f"""{name}_c AS (select variable, level, cast(sum(n) as bigint) n,
               cast(sum(n_good) as bigint) n_good, cast(sum(n_bad) as bigint) n_bad
        from {name}_c1 group by variable, level)""",
        f"{name} AS ({woe_cols_sql(name + '_c')})",
    ]


def info_table_ctes(name: str, cols: list[str], k: int, source: str = "lab") -> list[str]:
    """CTEs ending in ``{name}`` = quantile-bin table with woe, iv and iv_cum."""
    probs = ", ".join(repr(i / k) for i in range(1, k))
    u = unpivot_sql(source, cols, "double", value_name="x")
    return [
        f"{name}_u AS ({u})",
        f"""{name}_q AS (select variable, list_distinct(quantile_cont(x, [{probs}])) cuts
        from {name}_u group by variable)""",
        f"""{name}_b AS (select u.variable,
               case when x is null then -1
                    else cast(len(list_filter(q.cuts, lambda c: c < x)) as integer) end bin_id,
               x, tag
        from {name}_u u join {name}_q q on u.variable = q.variable)""",
        f"""{name}_c AS (select variable, bin_id, min(x) min_value, max(x) max_value, count(*) n,
               cast(sum(case when tag = 0 then 1 else 0 end) as bigint) n_good,
               cast(sum(case when tag = 1 then 1 else 0 end) as bigint) n_bad
        from {name}_b group by variable, bin_id)""",
        f"{name}_w AS ({woe_cols_sql(name + '_c')})",
        f"""{name} AS (select *, sum(iv) over (partition by variable order by bin_id
                                        rows between unbounded preceding and current row) iv_cum
        from {name}_w)""",
    ]


def monotone_ctes(name: str, bins: str) -> list[str]:
    return [f"""{name} AS (
      select variable, coalesce(sum(case when d > 0 then 1 else 0 end), 0) = 0
                       or coalesce(sum(case when d < 0 then 1 else 0 end), 0) = 0 is_monotone
      from (select variable, woe - lag(woe) over (partition by variable order by bin_id) d
            from {bins} where bin_id >= 0) s
      group by variable)"""]
