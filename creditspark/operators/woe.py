"""Weight of evidence (WOE) and information value (IV).

Contract (SURVEY WO1-WO10):
  good = label 0, bad = label 1 (the reference flips the tag so "1 = good").
  WOE_b = ln((good_b / G) / (bad_b / B)); a bin with zero good or zero bad
  gets WOE 0 and IV 0.  IV_b = (good_b / G - bad_b / B) * WOE_b.
  Quantile bins: cuts = distinct type-7 quantiles at i/k (i = 1..k-1);
  bin id = number of cuts strictly below x, so bins are (lo, hi];
  NULL is its own bin with id -1.

Scale: all variables are binned in ONE pass (unpivot -> groupBy(variable,
bin)), so the shuffle carries at most variables x bins rows per partition
after the map-side partial aggregation.  Only the bin table (variables x
bins, bounded by k or by the number of category levels) is collected to
the driver to build the fitted model; applying the model is a projection
with literal map lookups (no join, no shuffle).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditspark.operators.cache import persist, release, small
from creditspark.operators.quantiles import column_quantiles

MISC_LEVEL = "misc"


# --------------------------------------------------------------------------- helpers

def _good(label: str) -> Column:
    return F.when(F.col(label) == 0, 1).otherwise(0)


def _bad(label: str) -> Column:
    return F.when(F.col(label) == 1, 1).otherwise(0)


def add_woe_iv(counts: DataFrame, adjust: float = 0.0) -> DataFrame:
    """Given (variable, ..., n, n_good, n_bad) bin rows, add pct, woe, iv.

    Totals are one aggregate by variable that is joined back (one row per variable), so a variable
    with very many levels is not one task.  Without goods or without bads the WOE is 0.
    """
    totals = counts.groupBy("variable").agg(*[F.sum(c).cast("double").alias(t) for c, t in (("n", "__N"), ("n_good", "__G"), ("n_bad", "__B"))])
    out = counts.join(F.broadcast(totals), "variable")
    pg = F.try_divide(F.col("n_good").cast("double") + F.lit(adjust), F.col("__G"))
    pb = F.try_divide(F.col("n_bad").cast("double") + F.lit(adjust), F.col("__B"))
    zero_cell = (F.col("n_good") == 0) | (F.col("n_bad") == 0)
    woe = (F.when(zero_cell & F.lit(adjust == 0.0), F.lit(0.0))
            .otherwise(F.ln(F.try_divide(pg, pb))))
    out = (out.withColumn("pct", F.col("n").cast("double") / F.col("__N"))
              .withColumn("woe", F.coalesce(woe, F.lit(0.0)))
              .withColumn("iv", F.coalesce((pg - pb) * F.col("woe"), F.lit(0.0))))
    return out.drop("__N", "__G", "__B")


def _unpivot(df: DataFrame, ids: list[str], cols: list[str], value_type: str,
             var_name: str = "variable", value_name: str = "value") -> DataFrame:
    casted = df.select(*ids, *[F.col(c).cast(value_type).alias(c) for c in cols])
    return casted.unpivot(ids, cols, var_name, value_name)


# --------------------------------------------------------------------------- categorical (WO1)

def category_counts(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """(variable, level, n, n_good, n_bad) over labelled rows; NULL is a level."""
    lab = df.filter(F.col(label).isNotNull())
    long = _unpivot(lab, [label], cols, "string", value_name="level")
    return long.groupBy("variable", "level").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(_good(label)).cast("long").alias("n_good"),
        F.sum(_bad(label)).cast("long").alias("n_bad"))


def pool_levels(counts: DataFrame, min_share: float) -> DataFrame:
    """Pool non-NULL levels holding < min_share of a variable's rows into 'misc'."""
    if min_share <= 0:
        return counts
    totals = counts.groupBy("variable").agg(F.sum("n").cast("double").alias("__N"))
    share = F.col("n").cast("double") / F.col("__N")
    tagged = counts.join(F.broadcast(totals), "variable").withColumn(
        "level", F.when(F.col("level").isNotNull() & (share < F.lit(min_share)), F.lit(MISC_LEVEL))
                  .otherwise(F.col("level")))
    return tagged.groupBy("variable", "level").agg(
        F.sum("n").cast("long").alias("n"), F.sum("n_good").cast("long").alias("n_good"),
        F.sum("n_bad").cast("long").alias("n_bad"))


def woe_categorical(df: DataFrame, cols: list[str], label: str, min_share: float = 0.05,
                    adjust: float = 0.0) -> DataFrame:
    """Categorical WOE table (variable, level, n, n_good, n_bad, pct, woe, iv)."""
    return add_woe_iv(pool_levels(category_counts(df, cols, label), min_share), adjust)


# --------------------------------------------------------------------------- quantile bins (WO4/5)

def quantile_cuts(df: DataFrame, cols: list[str], k: int) -> dict[str, list[float]]:
    """Distinct type-7 quantile cuts at i/k per column (NULLs skipped).

    Returns a small dict (k - 1 values per column) for the fitted model.
    """
    return quantile_cuts_of(df, cols, [k])[0]


def quantile_cuts_of(df: DataFrame, cols: list[str], ks: list[int]) -> list[dict[str, list[float]]]:
    """``quantile_cuts`` for several numbers of bins, from one search."""
    probs = [[i / k for i in range(1, k)] for k in ks]
    every = sum(probs, [])
    vals = column_quantiles(df, cols, every) if cols and every else {c: [] for c in cols}
    out, at = [], 0
    for own in probs:
        out.append({c: sorted({float(v) for v in vals[c][at:at + len(own)] if v is not None}) for c in cols})
        at += len(own)
    return out


def bin_id(col: str | Column, cuts: list[float]) -> Column:
    """NULL -> -1, else number of cuts strictly below x (bins are (lo, hi])."""
    x = F.col(col).cast("double") if isinstance(col, str) else col.cast("double")
    if not cuts:
        return F.when(x.isNull(), F.lit(-1)).otherwise(F.lit(0))
    cnt = None
    for c in cuts:
        term = (x > F.lit(float(c))).cast("int")
        cnt = term if cnt is None else cnt + term
    return F.when(x.isNull(), F.lit(-1)).otherwise(cnt)


def numeric_bin_counts(df: DataFrame, cuts: dict[str, list[float]], label: str) -> DataFrame:
    """(variable, bin_id, min_value, max_value, n, n_good, n_bad), one pass over rows."""
    lab = df.filter(F.col(label).isNotNull())
    cols = list(cuts)
    packed = lab.select(label, *[
        F.struct(bin_id(c, cuts[c]).alias("bin_id"), F.col(c).cast("double").alias("x")).alias(c)
        for c in cols])
    long = packed.unpivot([label], cols, "variable", "v")
    return long.groupBy("variable", F.col("v.bin_id").alias("bin_id")).agg(
        F.min("v.x").alias("min_value"), F.max("v.x").alias("max_value"),
        F.count(F.lit(1)).alias("n"),
        F.sum(_good(label)).cast("long").alias("n_good"),
        F.sum(_bad(label)).cast("long").alias("n_bad"))


def info_table(df: DataFrame, cols: list[str], label: str, k: int = 10,
               cuts: dict[str, list[float]] | None = None) -> DataFrame:
    """Quantile-bin information table with cumulative IV per variable (WO4-WO6)."""
    lab = persist(df.filter(F.col(label).isNotNull()).select(label, *cols))
    cuts = cuts if cuts is not None else quantile_cuts(lab, cols, k)
    t = add_woe_iv(numeric_bin_counts(lab, cuts, label))
    w = Window.partitionBy("variable").orderBy("bin_id").rowsBetween(Window.unboundedPreceding, 0)
    return t.withColumn("iv_cum", F.sum("iv").over(w))


def iv_summary(bins: DataFrame) -> DataFrame:
    """(variable, iv) from a bin table (WO7)."""
    return bins.groupBy("variable").agg(F.sum("iv").alias("iv"))


def monotone_flags(bins: DataFrame) -> DataFrame:
    """(variable, is_monotone): non-NULL bins ordered by id, all WOE steps of one sign (WO9)."""
    w = Window.partitionBy("variable").orderBy("bin_id")
    steps = (bins.filter(F.col("bin_id") >= 0)
                 .withColumn("d", F.col("woe") - F.lag("woe").over(w))
                 .filter(F.col("d").isNotNull()))
    agg = steps.groupBy("variable").agg(
        F.sum(F.when(F.col("d") > 0, 1).otherwise(0)).alias("ups"),
        F.sum(F.when(F.col("d") < 0, 1).otherwise(0)).alias("downs"))
    names = bins.select("variable").distinct()
    return (names.join(agg, "variable", "left")
                 .select("variable", ((F.coalesce("ups", F.lit(0)) == 0)
                                      | (F.coalesce("downs", F.lit(0)) == 0)).alias("is_monotone")))


# --------------------------------------------------------------------------- supervised merge (WO2)

def _woe_iv_py(g, b, G, B):
    if g == 0 or b == 0 or G == 0 or B == 0:
        return 0.0, 0.0
    pg, pb = g / G, b / B
    w = math.log(pg / pb)
    return w, (pg - pb) * w


def _merged_edges(bins: list[list[int]], cuts: list[float], stop_limit: float) -> list[float]:
    """Edges left of one variable's (bin_id, n_good, n_bad) rows, ordered by bin."""
    G = sum(b[1] for b in bins) or 1
    B = sum(b[2] for b in bins) or 1
    # edge i separates bins i and i+1; it is cuts[bin_id_of_i] (ids can skip empties)
    edges = [cuts[bins[i][0]] for i in range(len(bins) - 1)]

    def total_iv(bs):
        return sum(_woe_iv_py(b[1], b[2], G, B)[1] for b in bs)

    while len(bins) > 1:
        cur = total_iv(bins)
        woes = [_woe_iv_py(b[1], b[2], G, B)[0] for b in bins]
        i = min(range(len(bins) - 1), key=lambda j: (abs(woes[j] - woes[j + 1]), j))
        merged = bins[:i] + [[bins[i][0], bins[i][1] + bins[i + 1][1], bins[i][2] + bins[i + 1][2]]] \
            + bins[i + 2:]
        new = total_iv(merged)
        loss = (cur - new) / cur if cur > 0 else 0.0
        if loss > stop_limit:
            break
        bins = merged
        edges = edges[:i] + edges[i + 1:]
    return edges


def supervised_merges(df: DataFrame, cols: list[str], label: str, start_bins: int = 20,
                      stop_limit: float = 0.1) -> dict[str, list[float]]:
    """Merged cut points of every column in ``cols``.

    All columns share one quantile search and one aggregate of ``start_bins`` bins each; then every variable's bin table
    (at most ``start_bins`` rows) is one group of a grouped map, which merges the adjacent non-NULL pair with the
    closest WOE while the relative IV loss of the step is <= ``stop_limit``.  Only the edges come to the driver.
    A column without values has no edges.
    """
    lab = persist(df.filter(F.col(label).isNotNull()).select(label, *cols))
    cuts = quantile_cuts(lab, cols, start_bins)

    def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values("bin_id")[["bin_id", "n_good", "n_bad"]].to_numpy().tolist()
        return pd.DataFrame({"variable": [key[0]], "edges": [_merged_edges(rows, cuts[key[0]], stop_limit)]})

    bins = numeric_bin_counts(lab, cuts, label).filter(F.col("bin_id") >= 0).select("variable", "bin_id", "n_good", "n_bad")
    found = {r["variable"]: list(r["edges"]) for r in bins.groupBy("variable").applyInPandas(merge, "variable string, edges array<double>").collect()}
    return {c: found.get(c, []) for c in cols}


def supervised_merge(df: DataFrame, col: str, label: str, start_bins: int = 20, stop_limit: float = 0.1) -> list[float]:
    """``supervised_merges`` of one column."""
    return supervised_merges(df, [col], label, start_bins, stop_limit)[col]


def merge_similar_levels(levels: dict[str, tuple[int, int]], stop_limit: float = 0.1) -> dict[str, str]:
    """WO1 option: merge categories with similar WOE.

    ``levels`` maps level -> (n_good, n_bad) (NULL excluded; the table is the
    bounded level table of a fitted model).  Levels are ordered by WOE and the
    adjacent pair with the closest WOE is merged while the relative IV loss of
    the step is <= ``stop_limit``.  Returns level -> group label ("a+b", sorted).
    """
    G = sum(g for g, _ in levels.values()) or 1
    B = sum(b for _, b in levels.values()) or 1
    groups = [([lv], g, b) for lv, (g, b) in levels.items()]

    def woe_of(g, b):
        return _woe_iv_py(g, b, G, B)[0]

    def total_iv(gs):
        return sum(_woe_iv_py(g, b, G, B)[1] for _, g, b in gs)

    groups.sort(key=lambda t: (woe_of(t[1], t[2]), sorted(t[0])))
    while len(groups) > 1:
        cur = total_iv(groups)
        w = [woe_of(g, b) for _, g, b in groups]
        i = min(range(len(groups) - 1), key=lambda j: (abs(w[j + 1] - w[j]), j))
        merged = groups[:i] + [(groups[i][0] + groups[i + 1][0], groups[i][1] + groups[i + 1][1],
                                groups[i][2] + groups[i + 1][2])] + groups[i + 2:]
        loss = (cur - total_iv(merged)) / cur if cur > 0 else 0.0
        if loss > stop_limit:
            break
        groups = merged
    return {lv: "+".join(sorted(members)) for members, _, _ in groups for lv in members}


# --------------------------------------------------------------------------- fitted model (WO3/WO10)

@dataclass
class WoeModel:
    """Fitted binning: literal lookups applied as a projection (no join)."""
    categorical: dict[str, dict] = field(default_factory=dict)  # var -> {levels:{lvl:woe}, null, misc}
    numeric: dict[str, dict] = field(default_factory=dict)      # var -> {cuts:[..], woe:{bin:woe}}
    lookups: dict[str, tuple] = field(default_factory=dict)     # var -> (DataFrame(level, woe), null, misc)

    def woe_column(self, var: str) -> Column:
        if var in self.categorical:
            spec = self.categorical[var]
            x = F.col(var).cast("string")
            levels = spec["levels"]
            if levels:
                m = F.create_map(*[v for kv in levels.items() for v in (F.lit(kv[0]), F.lit(float(kv[1])))])
                hit = F.try_element_at(m, x)
            else:
                hit = F.lit(None).cast("double")
            fallback = F.lit(float(spec.get("misc", 0.0) or 0.0))
            return (F.when(x.isNull(), F.lit(float(spec.get("null", 0.0) or 0.0)))
                     .otherwise(F.coalesce(hit, fallback)))
        spec = self.numeric[var]
        b = bin_id(var, spec["cuts"])
        m = F.create_map(*[v for kv in spec["woe"].items() for v in (F.lit(int(kv[0])), F.lit(float(kv[1])))])
        return F.coalesce(F.try_element_at(m, b), F.lit(0.0))

    @property
    def variables(self) -> list[str]:
        return list(self.categorical) + list(self.lookups) + list(self.numeric)

    def transform(self, df: DataFrame, prefix: str = "woe_", replace: bool = False) -> DataFrame:
        """Add ``woe_<var>`` columns, or overwrite the originals when ``replace``.

        Literal lookups are a projection; variables without pooled levels are a left join against their
        level table, broadcast if it is counted to be small.  NULLs match no level and are spread by
        the planner's skew handling.
        """
        out = df
        for v, (table, null_woe, misc_woe) in self.lookups.items():
            name = v if replace else f"{prefix}{v}"
            lk = table.select(F.col("level").alias(f"__lvl_{v}"), F.col("woe").alias(f"__woe_{v}"))
            out = out.join(small(lk), F.col(v).cast("string") == F.col(f"__lvl_{v}"), "left")
            out = out.withColumn(name, F.when(F.col(v).isNull(), F.lit(float(null_woe)))
                                 .otherwise(F.coalesce(F.col(f"__woe_{v}"), F.lit(float(misc_woe)))))
            out = out.drop(f"__lvl_{v}", f"__woe_{v}")
        cols = {(v if replace else f"{prefix}{v}"): self.woe_column(v)
                for v in list(self.categorical) + list(self.numeric)}
        return out.withColumns(cols)


class WoeBinner:
    """Estimator: learns category WOE and quantile-bin WOE on labelled rows."""

    def __init__(self, label: str = "tag", categorical: list[str] | None = None,
                 numeric: list[str] | None = None, k: int = 10, min_share: float = 0.05,
                 merge_limit: float | None = None):
        if merge_limit is not None and min_share <= 0:
            raise ValueError("merge_limit needs min_share > 0, which bounds the number of levels")
        self.label, self.k, self.min_share = label, k, min_share
        self.merge_limit = merge_limit  # None: no similarity merge of category levels
        self.categorical = categorical or []
        self.numeric = numeric or []

    def fit(self, df: DataFrame) -> WoeModel:
        model = WoeModel()
        lab = persist(df.filter(F.col(self.label).isNotNull())
                      .select(self.label, *self.categorical, *self.numeric))
        if self.categorical:
            table = persist(woe_categorical(lab, self.categorical, self.label, self.min_share))
            # pooling leaves at most 1 / min_share levels and three more: literals.  Without it a level
            # table stays a DataFrame, however small it is
            literal = self.categorical if self.min_share > 0 else []
            for v in self.categorical:
                if v in literal:
                    continue
                special = {r["level"]: r["woe"] for r in table.filter(
                    (F.col("variable") == v) & (F.col("level").isNull() | (F.col("level") == MISC_LEVEL))).collect()}
                model.lookups[v] = (table.filter((F.col("variable") == v) & F.col("level").isNotNull())
                                    .select("level", "woe"), special.get(None, 0.0), special.get(MISC_LEVEL, 0.0))
            t = table.filter(F.col("variable").isin(literal)).collect() if literal else []
            for v in literal:
                rows = [r for r in t if r["variable"] == v]
                if self.merge_limit is not None:
                    rows = self._merged_rows(rows)
                spec = {"levels": {}, "null": 0.0, "misc": 0.0}
                for r in rows:
                    if r["level"] is None:
                        spec["null"] = r["woe"]
                    elif r["level"] == MISC_LEVEL:
                        spec["misc"] = r["woe"]
                        spec["levels"][MISC_LEVEL] = r["woe"]
                    else:
                        spec["levels"][r["level"]] = r["woe"]
                model.categorical[v] = spec
        if self.numeric:
            cuts = quantile_cuts(lab, self.numeric, self.k)
            t = add_woe_iv(numeric_bin_counts(lab, cuts, self.label)).collect()
            for v in self.numeric:
                model.numeric[v] = {"cuts": cuts[v],
                                    "woe": {r["bin_id"]: r["woe"] for r in t if r["variable"] == v}}
        release(lab)
        return model

    def _merged_rows(self, rows):
        """Replace each non-NULL level's WOE by the WOE of its similarity group."""
        counts = {r["level"]: (r["n_good"], r["n_bad"]) for r in rows if r["level"] is not None}
        group_of = merge_similar_levels(counts, self.merge_limit)
        G = sum(r["n_good"] for r in rows) or 1
        B = sum(r["n_bad"] for r in rows) or 1
        sums = {}
        for lv, (g, b) in counts.items():
            sg, sb = sums.get(group_of[lv], (0, 0))
            sums[group_of[lv]] = (sg + g, sb + b)
        out = [r for r in rows if r["level"] is None]
        for lv in counts:
            g, b = sums[group_of[lv]]
            out.append({"level": lv, "woe": _woe_iv_py(g, b, G, B)[0]})
        return out


def model_bins(spark: SparkSession, model: WoeModel) -> DataFrame:
    """The fitted model's lookup table as a small DataFrame (variable, key, woe)."""
    rows = []
    for v, spec in model.categorical.items():
        rows.append((v, None, float(spec["null"])))
        rows += [(v, str(k), float(w)) for k, w in spec["levels"].items()]
    for v, spec in model.numeric.items():
        rows += [(v, str(k), float(w)) for k, w in spec["woe"].items()]
    schema = T.StructType([T.StructField("variable", T.StringType()), T.StructField("key", T.StringType()),
                           T.StructField("woe", T.DoubleType())])
    return spark.createDataFrame(rows, schema)
