"""Keys that hold the tree engine against SQL: one tree of depth 2 over features binned by fixed steps, all rows, all features."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from creditspark.operators import trees as T
from creditspark.plans.catalog import register
from creditspark.plans.oracle_base import with_fixture
from creditspark.sources import fixtures as fx

STEPS = ["trades", "price_step", "tenure_step", "nation_step"]
BINS = 32

_BINNED = """x AS (select cast(tag as double) y, least(coalesce(n_trades, 0), 31)::int v0, least(floor(price / 20000), 31)::int v1,
                      least(floor(tenure_days / 90.0), 31)::int v2, nation::int v3 from lab)"""


def _level(name: str, rows: str, score: str, least: str, least_gain: str) -> list[str]:
    """CTEs for the best split of each node of ``rows`` (node, y, v0..v3)."""
    return [
        f"""{name}_c AS (select node, f, v, count(*)::double n, sum(y)::double k from
             (select node, y, unnest([0, 1, 2, 3]) f, unnest([v0, v1, v2, v3]) v from {rows}) group by 1, 2, 3)""",
        f"""{name}_t AS (select node, count(*)::double n, sum(y)::double k from {rows} group by 1)""",
        f"""{name}_l AS (select a.node, a.f, a.v, t.n tn, t.k tk, sum(a.n) over w n, sum(a.k) over w k
             from {name}_c a join {name}_t t using (node) window w as (partition by a.node, a.f order by a.v))""",
        f"""{name}_g AS (select *, {score.format(k='k', n='n')} + {score.format(k='(tk - k)', n='(tn - n)')} - {score.format(k='tk', n='tn')} gain
             from {name}_l where n < tn and {least})""",
        f"""{name} AS (select * from (select *, row_number() over (partition by node order by round(gain, 9) desc, f, v) r from {name}_g)
             where r = 1 and gain > {least_gain})""",
    ]


def _oracle(score: str, least: str, least_gain: str) -> str:
    pick = "case s.f when 0 then v0 when 1 then v1 when 2 then v2 else v3 end"
    parts = [_BINNED, "r1 AS (select 1 node, x.* from x)", *_level("s1", "r1", score, least, "1e-9"),
             f"r2 AS (select 2 + (({pick}) > s.v)::int node, y, v0, v1, v2, v3 from x cross join s1 s)",
             "p2 AS (select node from r2 group by 1 having min(y) < max(y))", "q2 AS (select * from r2 where node in (select node from p2))",
             *_level("s2", "q2", score, least, least_gain)]
    out = "select node, ['trades', 'price_step', 'tenure_step', 'nation_step'][f + 1] feature, v::int cut, tn::bigint n, tk::bigint k, round(gain, 5) gain from {}"
    return with_fixture(f"{out.format('s1')} union all {out.format('s2')}", *parts)


def _matrix(spark, d):
    lab = fx.modelling_table(spark, d).filter(F.col("tag").isNotNull())
    up_to = lambda c: F.least(c, F.lit(BINS - 1)).cast("int")
    x = lab.select("application_id", "tag", up_to(F.coalesce("n_trades", F.lit(0))).alias("trades"), up_to(F.floor(F.col("price") / 20000)).alias("price_step"),
                   up_to(F.floor(F.col("tenure_days") / 90.0)).alias("tenure_step"), F.col("nation").cast("int").alias("nation_step"))
    edges = [np.arange(BINS - 1) + 0.5] * len(STEPS)
    return T.binned(x, STEPS, "tag", "application_id", edges=edges)


def _nodes(spark, tree, n, k):
    inner = np.flatnonzero(tree.feature >= 0).tolist()
    return spark.createDataFrame([(i, STEPS[int(tree.feature[i])], int(tree.cut[i]), int(round(n(i))), int(round(k(i))), round(float(tree.gain[i]), 5)) for i in inner],
                                 "node int, feature string, cut int, n long, k long, gain double")


@register("tree_gini_splits", _oracle("({k} * {k} + ({n} - {k}) * ({n} - {k})) / {n}", "true", "1e-9"))
def tree_gini_splits(spark, d):
    """ML7: the splits of one classification tree of depth 2, with impurity decrease (ML9's summand)."""
    m = _matrix(spark, d)
    tree = T.grow(m, [T.Plan(0, 1, len(STEPS), sample=False)], depth=2)[0].trees[0]
    return _nodes(spark, tree, lambda i: tree.h[i], lambda i: tree.g[i])


# at margin 0 a row's gradient is 1/2 - y and its Hessian 1/4
@register("tree_newton_splits", _oracle("(({n} / 2 - {k}) * ({n} / 2 - {k})) / ({n} / 4 + 1)", "n / 4 >= 2 and (tn - n) / 4 >= 2", "5"))
def tree_newton_splits(spark, d):
    """ML10: the splits of the first boosted tree (depth 2): second-order gain, gamma 5, child weight 2, L2 penalty 1."""
    m = _matrix(spark, d)
    tree = T.boost(m, T.Boost(rounds=1, depth=2, colsample=1.0))[0].trees[0]
    return _nodes(spark, tree, lambda i: 4 * tree.h[i], lambda i: 2 * tree.h[i] - tree.g[i])
