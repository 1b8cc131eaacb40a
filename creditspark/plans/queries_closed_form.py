"""Model operators on designs whose answers SQL can give in closed form.

The predictors are indicators of one categorical column, so every subset of them is a model of
level groups: its fitted probabilities are default rates, and coefficients, standard errors, AIC and
variance inflation follow from counts.  The same operators serve the real designs of
``queries_models``.
"""

from __future__ import annotations

import math

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from creditspark.operators import models as M
from creditspark.plans.catalog import r6, register
from creditspark.plans.oracle_base import with_fixture
from creditspark.sources import fixtures as fx

FOURIER_SIGMA, FOURIER_COMPONENTS, FOURIER_SEED = 0.3, 4, 1
FOURIER_FEATURES = ["util", "n_trades"]
FOURIER_WEIGHTS, FOURIER_INTERCEPT = [0.8, -0.5, 0.3, -0.9], 0.1  # fixed values: a classifier over the map


def _indicators(spark, d):
    """Labelled rows with a 0/1 column per level of ``segment`` but the last (a bounded set of levels)."""
    lab = fx.modelling_table(spark, d).filter(F.col("tag").isNotNull()).select("segment", "tag")
    levels = [r[0] for r in lab.select("segment").distinct().orderBy("segment").collect()]
    terms = [f"seg_{i}" for i in range(len(levels) - 1)]
    return lab.select("tag", *[(F.col("segment") == lv).cast("double").alias(t) for t, lv in zip(terms, levels)]), terms


#: lv: counts of each level; sub: counts of the pooled levels for every subset m of the terms, with its AIC;
#: zs: the squared z value of every term of every subset.
_SUBSETS = [
    """lv AS (select row_number() over (order by segment) - 1 as i, count(*)::double n, sum(tag)::double k,
                     count(*) over () - 1 as terms from lab group by segment)""",
    "bits AS (select * from lv where i < terms)",
    "masks AS (select unnest(range(0, (1 << (select max(terms) from lv))::bigint)) as m)",
    """sub AS (select m, sum(n) filter (i = terms or (m >> i) & 1 = 0) as nr, sum(k) filter (i = terms or (m >> i) & 1 = 0) as kr,
                      sum(k * ln(k / n) + (n - k) * ln(1 - k / n)) filter (i < terms and (m >> i) & 1 = 1) as own
               from masks cross join lv group by m)""",
    """aics AS (select m, -2 * (coalesce(own, 0) + kr * ln(kr / nr) + (nr - kr) * ln(1 - kr / nr)) + 2 * (bit_count(m) + 1) as aic from sub)""",
    """zs AS (select m, i, power(ln(k / (n - k)) - ln(kr / (nr - kr)), 2) / (n / (k * (n - k)) + nr / (kr * (nr - kr))) as z2
              from sub join bits on (m >> i) & 1 = 1)""",
]


def _recursive(body: str, *ctes: str) -> str:
    return with_fixture(body, *_SUBSETS, *ctes).replace("WITH", "WITH RECURSIVE", 1)


@register("step_aic_levels", _recursive(
    "select step::int as step, action, term, round(aic, 4) as aic from path",
    """best AS (select m, m2, aic, action, term from (
         select a.m, b.m as m2, b.aic, case when b.m < a.m then 'drop' else 'add' end as action, 'seg_' || i as term,
                row_number() over (partition by a.m order by b.aic, i) as r, a.aic as was
         from aics a join bits on true join aics b on b.m = xor(a.m, (1 << i)::bigint)
         where b.m > a.m or bit_count(a.m) > 1) s where r = 1 and aic < was)""",
    """path AS (select 0 as step, m, aic, 'start' as action, null::varchar as term from aics where m = (select max(m) from aics)
                union all select step + 1, m2, b.aic, b.action, b.term from path p join best b on b.m = p.m)"""))
def step_aic_levels(spark, d):
    """ML3: the stepwise AIC path over level indicators."""
    df, terms = _indicators(spark, d)
    _, path = M.step_aic(df, terms, "tag")
    return spark.createDataFrame([(int(s), a, t, float(v)) for s, a, t, v in path], "step int, action string, term string, aic double") \
        .withColumn("aic", F.round("aic", 4))


@register("backward_levels", _recursive(
    "select step::int as step, dropped, round(aic, 4) as aic from path join aics using (m)",
    """worst AS (select m, i from (select *, row_number() over (partition by m order by z2, i desc) as r from zs)
                 where r = 1 and z2 < power(1.959963984540054, 2) and bit_count(m) > 1)""",
    """path AS (select 0 as step, max(m) as m, null::varchar as dropped from aics
                union all select step + 1, xor(p.m, (1 << i)::bigint), 'seg_' || i from path p join worst w on w.m = p.m)"""))
def backward_levels(spark, d):
    """ML4: backward elimination by p-value over level indicators."""
    df, terms = _indicators(spark, d)
    _, path = M.backward_pvalue(df, terms, "tag")
    return spark.createDataFrame([(int(s), t, float(a)) for s, t, _, a in path], "step int, dropped string, aic double") \
        .withColumn("aic", F.round("aic", 4))


@register("vif_levels", with_fixture(
    """select 'seg_' || i as variable, round((v + vr) * (1 / v - vr / (v * v) / (1 + vr * s)), 6) as vif
       from (select i, n / (k * (n - k)) as v, (select n / (k * (n - k)) from lv where i = terms) as vr,
                    (select sum(k * (n - k) / n) from bits) as s from bits) t""", *_SUBSETS[:2]))
def vif_levels(spark, d):
    """ML5: variance inflation of the model over all level indicators."""
    df, terms = _indicators(spark, d)
    return spark.createDataFrame(M.vif(df, M.fit_logit(df, terms, "tag", tol=1e-12)), "variable string, vif double").select("variable", r6("vif"))


def _fourier_sql():
    w, b = M.fourier_matrix(len(FOURIER_FEATURES), FOURIER_SIGMA, FOURIER_COMPONENTS, FOURIER_SEED)
    scale = math.sqrt(2 / FOURIER_COMPONENTS)
    cols = [f"round({scale!r} * cos({' + '.join(f'{float(w[i, j])!r} * {f}' for i, f in enumerate(FOURIER_FEATURES))} + {float(b[j])!r}), 6) as z{j}"
            for j in range(FOURIER_COMPONENTS)]
    return with_fixture(f"select application_id, {', '.join(cols)} from mt where bal is not null")


@register("fourier_values", _fourier_sql())
def fourier_values(spark, d):
    """ML14: values of the random Fourier map."""
    mt = fx.modelling_table(spark, d).filter(F.col("bal").isNotNull()).select("application_id", *FOURIER_FEATURES)
    z = M.fourier_features(mt, FOURIER_FEATURES, FOURIER_SIGMA, FOURIER_COMPONENTS, FOURIER_SEED)
    arr = vector_to_array(F.col("features"))
    return z.select("application_id", *[F.round(arr[j], 6).alias(f"z{j}") for j in range(FOURIER_COMPONENTS)])


def _fourier_class_sql():
    w, b = M.fourier_matrix(len(FOURIER_FEATURES), FOURIER_SIGMA, FOURIER_COMPONENTS, FOURIER_SEED)
    scale = math.sqrt(2 / FOURIER_COMPONENTS)
    margin = " + ".join(f"{c!r} * {scale!r} * cos({' + '.join(f'{float(w[i, j])!r} * {f}' for i, f in enumerate(FOURIER_FEATURES))} + {float(b[j])!r})"
                        for j, c in enumerate(FOURIER_WEIGHTS))
    return with_fixture(f"""select application_id, round(m, 6) as margin, case when m > 0 then 1 else 0 end as pred
                            from (select application_id, {margin} + {FOURIER_INTERCEPT!r} as m from mt where bal is not null)""")


@register("fourier_classes", _fourier_class_sql())
def fourier_classes(spark, d):
    """ML14: margins and classes of a linear classifier over the Fourier map."""
    mt = fx.modelling_table(spark, d).filter(F.col("bal").isNotNull()).select("application_id", *FOURIER_FEATURES)
    z = M.fourier_features(mt, FOURIER_FEATURES, FOURIER_SIGMA, FOURIER_COMPONENTS, FOURIER_SEED)
    return z.select("application_id", M.linear_margin("features", FOURIER_WEIGHTS, FOURIER_INTERCEPT).alias("margin")) \
        .select("application_id", r6("margin"), (F.col("margin") > 0).cast("int").alias("pred"))
